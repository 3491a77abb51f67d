import json

import pytest

from studyloom.operators import answers as X
from studyloom.operators import inference as L
from studyloom.operators import registry as G


def brute_objects(text):
    """Complete outermost objects, letter by letter."""
    out, depth, begin, inside, escaped = [], 0, -1, False, False
    for i, ch in enumerate(text):
        if inside:
            inside, escaped = (not (ch == '"' and not escaped)), ch == "\\" and not escaped
        elif ch == '"':
            inside = True
        elif ch == "{":
            begin, depth = (i if depth == 0 else begin), depth + 1
        elif ch == "}" and depth:
            depth -= 1
            if depth == 0:
                out.append(text[begin : i + 1])
    return out


CUT = '{"x": 1, "subpopulations": [{"name": "a {b}", "counts": [{"n": 1}]}, {"name": "q\\"}"}, {"name": "cut'


@pytest.mark.parametrize("text", [CUT, '{"a": "}"} {"b": {"c": 1}} }{', '"{"', "{", "", '{"k": "\\\\"}{"z": "']) 
def test_whole_objects(text):
    assert X.whole_objects(text) == brute_objects(text)


def test_answers_are_read_or_saved(spark):
    p = [CUT, "```json\n{\"a\": [1,],}\n```", 'Here: {"a": 1}', "[1, 2]", None, "", '{"datasets": [', '{"people_involved": [{"n": 1}, {"bad" 2}'] 
    rows = X.answers(spark.createDataFrame([(i, x, "c") for i, x in enumerate(p)], "id long, payload string, value string").select("id", "payload"), "payload").orderBy("id").collect()
    assert [r.how for r in rows] == ["salvaged", "commas", "whole", "whole", "none", "none", "none", "salvaged"]
    assert json.loads(rows[0].value) == {"subpopulations": [{"name": "a {b}", "counts": [{"n": 1}]}, {"name": 'q"}'}]} and rows[7].value == '{"people_involved": [{"n": 1}]}'


def test_section_columns_and_chat_content(spark):
    df = spark.createDataFrame([(1, '{"name": "x", "tags": ["a", "é"], "n": 0}', None)], "id long, over string, info string")
    got = X.section_columns(df, {"over": ["tags", "name", "n", "none"], "info": ["theme"]}).first()
    assert list(got) == [1, '["a", "é"]', "x", "0", "", ""]
    chats = ['{"choices": [{"message": {"content": "a"}}]}', '{"choices": [{"message": {"content": [{"text": "a"}, "b", {"x": 1}, {"text": " "}]}}]}', '{"choices": []}', "no", None]
    out = spark.createDataFrame([(i, c) for i, c in enumerate(chats)], "i long, c string").select("i", X.chat_content("c").alias("t")).orderBy("i").collect()
    assert [r.t for r in out] == ["a", "a\nb", "", "", ""]


def test_items_are_matched_and_laid_over():
    details = [{"name": "other", "n": 1}, {"pid": "P1", "n": 2}, {"name": "Women of the north", "n": 3}]
    assert X.detail_of({"pid": "p1", "name": "x"}, details)["n"] == 2 and X.detail_of({"name": "women"}, details)["n"] == 3
    assert X.detail_of({"name": "zzz"}, details)["n"] == 1 and X.detail_of({"name": "a"}, []) is None
    assert X.overlaid({"a": 1, "b": 2}, {"a": " ", "b": 3}) == {"a": 1, "b": 3} and X.overlaid({"a": 1}, None) == {"a": 1}
    assert X.distinct_items([{"name": "A"}, {"name": "a "}, {"x": ""}, {"z": 1}, {"z": 1}, None]) == [{"name": "A"}, {"z": 1}, {"z": 1}]
    assert X.names_of([{"name": " "}, {"pid": "p"}, {"name": "n"}, None], "sub") == ["sub_1", "p", "n", "sub_4"]


def overflowing():
    def client(prompt):
        if len(prompt) > 6000:
            raise L.ContextOverflow
        return json.dumps({"n": prompt.count("word"), "tags": [str(len(prompt) % 7)]})

    return client


def staged():
    def client(prompt):
        if "Only the item" in prompt:
            name = json.loads(prompt.split("Only the item: ")[1].split("\n")[0])["name"]
            return json.dumps({"subpopulations": [{"name": "wrong"}, {"name": name, "n": len(name)}]})
        return json.dumps({"subpopulations": [{"name": x} for x in ("alpha", "be", "alpha", "")]})

    return client


def test_overflow_is_asked_in_chunks_and_two_stages_keep_order(spark):
    docs = spark.createDataFrame([(1, "word " * 3000), (2, "word"), (3, None)], "id long, t string")
    got = {r.id: (r.way, r.n_chunks) for r in L.extract(docs, "id", "t", {"n": None, "tags": [], "more": {}}, "", overflowing, size=4000, overlap=0, pause=0).collect()}
    assert got[1][0] == "chunks" and got[1][1] > 3 and got[2] == ("whole", 1) and got[3] == ("none", 0)
    two = {r.id: (json.loads(r.result)["subpopulations"], r.n_seeds, r.n_calls) for r in L.extract_two_stages(docs.filter("id <> 1"), "id", "t", {"subpopulations": [{"name": None, "n": None}]}, "", staged, pause=0).collect()}
    assert two[2] == ([{"name": "alpha", "n": 5}, {"name": "be", "n": 2}], 2, 3) and two[3] == ([], 0, 0)
    passes = {"a": ({"n": None}, ""), "b": ({"subpopulations": [{"name": None}]}, "")}
    out = L.extract_passes(docs.filter("id = 2"), "id", "t", passes, staged, two_stage=("b",), pause=0)
    assert sorted((r.id, r.section) for r in out.collect()) == [(2, "a"), (2, "b")]
    assert L.seed_template({"subpopulations": [{"pid": 1, "x": 2}]}) == {"subpopulations": [{"pid": 1}]} and L.pooled([overflowing, overflowing])()("word") 


def test_registry_inherits_from_files_rows(spark, monkeypatch, tmp_path):
    rows = [("A", "B", "x", "int", None, 1), ("B", None, "x", "string", None, 2), ("B", None, "y", "ontology", "Lists", 3), ("C", "A", None, None, None, 4), (None, None, "z", None, None, 5)]
    m = spark.createDataFrame(rows, "tableName string, tableExtends string, columnName string, columnType string, refTable string, pos long")
    reg = G.registry(m, spark.createDataFrame([("Lists", "a"), ("Lists", "a"), ("Lists", "b")], "source string, name string"))
    assert sorted((r.tbl, r.col, r.kind, r.direct, r.n_allowed) for r in reg.select("tbl", "col", "kind", "direct", F_n(reg)).collect()) == [("A", "x", "int", True, 0), ("A", "y", "ontology", False, 2), ("B", "x", "string", True, 0), ("B", "y", "ontology", True, 2)]
    assert [r.tbl for r in G.table_names(m).orderBy("pos").collect()] == ["A", "B", "C"]
    (tmp_path / "v.txt").write_text("one\n\n two \n")
    (tmp_path / "v.json").write_text('["x", " ", "y"]')
    got = [r.value for r in G.typed_values(spark, ["a, b"], str(tmp_path / "v.txt"), str(tmp_path / "v.json")).orderBy("pos").collect()]
    assert got == ["a", "b", "one", "two", "x", "y"]
    assert G.first_existing(spark, ["", str(tmp_path / "no"), str(tmp_path / "v.txt")]) == str(tmp_path / "v.txt") and G.first_existing(spark, []) is None
    monkeypatch.setenv("SIZE", " 3 ")
    assert G.env_int("SIZE", 9) == 3 and G.env_int("SIZE", 9, 5) == 5 and G.env_int("NONE_SUCH", 9) == 9
    w = spark.createDataFrame([("Resources", "Name"), ("Other", "name")], "tbl string, col string")
    e = spark.createDataFrame([("Collections", "name", "g", "b")], "tbl string, col string, good string, bad string")
    assert {r.tbl: r.good for r in G.example_overrides(w, e).collect()} == {"Resources": "g", "Other": None}


def F_n(_):
    from pyspark.sql import functions as F

    return F.coalesce("n_allowed", F.lit(0)).alias("n_allowed")
