import json

from hypothesis import given, settings
from hypothesis import strategies as st
import random

from pyspark.sql import functions as F

from studyloom.functions import text as T
from studyloom.operators import inference, skew
from studyloom.operators import relational as R
from studyloom.operators.chunks import chunk_bounds, chunk_table
from studyloom.operators.fuzzy import fuzzy_match


def test_parents_with_blank_ids_stay(spark, rows):
    p = spark.createDataFrame([("a",), (" b",), ("",), (None,), ("c",)], "id string")
    c = spark.createDataFrame([("a ",), ("b",), ("",), (None,)], "id string")
    assert rows(R.drop_parents_with_children(p, c, "id", "id")) == sorted([("",), (None,), ("c",)], key=repr)


def test_full_merge_keeps_both_sides(spark, rows):
    a = spark.createDataFrame([("m0", 1, ["x"]), ("m6", 2, None)], "k string, v long, tags array<string>")
    b = spark.createDataFrame([("m0", None, ["X", "y"]), ("m9", 3, [])], "k string, v long, tags array<string>")
    assert rows(R.full_merge(a, b, "k", ["v", "tags"])) == [("m0", 1, ["x", "y"]), ("m6", 2, []), ("m9", 3, [])]


def test_ambiguous_tokens_are_left_out(spark, rows):
    df = spark.createDataFrame([("A", "one", "x"), ("B", "One", "y"), ("A", "one", None)], "c string, n string, l string")
    assert rows(R.unambiguous_index(df, "c", ["n", "l"], T.norm_key)) == [("x", "A"), ("y", "B")]


def test_identity_inheritance_and_defaults(spark, rows):
    df = spark.createDataFrame([(1, "k"), (2, "k"), (3, ""), (4, None)], "i long, k string")
    assert rows(R.first_by_identity(df, F.col("k"), "i").select("i")) == [(1,), (3,), (4,)]
    cols = spark.createDataFrame([("P", "a", 1, "int"), ("C", "a", 1, "text"), ("C", "b", 2, "int")], "tbl string, col string, pos long, kind string")
    out = R.inherit_columns(cols, spark.createDataFrame([("C", "P"), ("P", "C")], "tbl string, parent string"))
    assert rows(out.filter("tbl = 'C'").select("col", "kind", "defined_in")) == [("a", "text", "C"), ("b", "int", "C")]


def test_hot_join_and_blocked_pairs(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    r = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(20)], "i long, k string")
    m = spark.createDataFrame([("hot", 1), ("k0", 2)], "k string, v long")
    got = {(x.i, x.v) for x in skew.join_hot(r, m, ["k"], r.groupBy("k").agg(F.count(F.lit(1)).alias("n"))).collect()}
    assert got == {(i, 1 if i % 2 else 2 if i == 0 else None) for i in range(20)}
    pairs = skew.self_pairs(r, ["k"], "i", ["k"], block=3)
    odd = [i for i in range(20) if i % 2]
    assert {(x.i_a, x.i_b) for x in pairs.collect()} == {(a, b) for a in odd for b in odd if a < b}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n", max_size=9000), st.integers(0, 5000), st.integers(-5, 3000))
def test_chunks_cover_the_text(text, size, overlap):
    out = chunk_bounds(text, size, overlap)
    assert all(len(c) <= max(2000, size) or c == text for c in out)
    at = 0
    for c in out:
        assert (at := text.find(c, max(0, at - max(2000, size)))) >= 0
    assert sum(len(c.replace(" ", "").replace("\n", "")) for c in out) >= len(text.replace(" ", "").replace("\n", ""))


def test_chunk_table_nulls_and_empty(spark, rows):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 4500)], "k long, t string")
    assert rows(chunk_table(df, "k", "t", 2000, 0).select("k", "idx", F.length("chunk"))) == [(2, 1, 0), (3, 1, 2000), (3, 2, 2000), (3, 3, 500)]


def test_fuzzy_needs_cutoff_and_margin(spark):
    v = spark.createDataFrame([("nothumbria",), ("abcd1",), (None,)], "raw string")
    got = {r.raw: (r.canonical, r.suggestions[0]) for r in fuzzy_match(v, "raw", spark.createDataFrame([("northumbria", "Northumbria"), ("abcd2", "X"), ("abcd3", "Y")], "key string, canonical string"), cutoff=0.7).collect()}
    assert got["nothumbria"] == ("Northumbria", "Northumbria") and got["abcd1"][0] is None


def stub():
    seen = []

    def client(prompt):
        seen.append(1)
        if len(seen) == 1:
            raise OSError("loading")
        return "no json" if len(seen) == 2 else 'ok {"name": "N", "tags": ["a", "A"], "flag": "true",}'

    return client


def test_extraction_retries_reads_and_merges(spark):
    df = spark.createDataFrame([(1, "word " * 1000), (2, None)], "k long, t string").coalesce(1)
    got = {r.k: r for r in inference.extract(df, "k", "t", {"name": "string|null", "tags": ["string"], "more": ["string"]}, "", stub, size=2000, overlap=0, tries=3, pause=0, threshold=1000).collect()}
    assert json.loads(got[1].result) == {"name": "N", "tags": ["a"], "more": [], "flag": True} and got[1].n_chunks == 3 and got[1].n_calls == 5
    assert json.loads(got[2].result) == {"name": None, "tags": [], "more": []} and got[2].n_chunks == 0


def test_fuzzy_residual_covers_both_lists(spark, tmp_path):
    from studyloom.plans.relational_queries import ontology_fuzzy

    entry = "name string, label string, acronym string, code string"
    spark.createDataFrame([("Xylandania", None, None, "XY")], entry).write.parquet(f"{tmp_path}/countries.parquet")
    spark.createDataFrame([("Northumbria", None, None, "NO")], entry).write.parquet(f"{tmp_path}/regions.parquet")
    raw = [(1, "countries", "Xylandaniaa"), (2, "regions", "Northumbrja"), (3, "regions", "Northumbria"), (4, "regions", " ")]
    spark.createDataFrame(raw, "match_id long, field string, raw string").write.parquet(f"{tmp_path}/choice_matches.parquet")
    got = {(r.field, r.raw): (r.canonical, r.method) for r in ontology_fuzzy(spark, str(tmp_path)).collect()}
    assert got == {
        ("countries", "Xylandaniaa"): (None, "unmapped"),
        ("regions", "Northumbrja"): (None, "unmapped"), ("regions", "Northumbria"): ("Northumbria", "exact"), ("regions", " "): (None, "empty"),
    }
    # 20 of 21 letters in common: 0.952 is below the cutoff.


def deal_brute(rows):
    """Ids of (own, slug) of one group, one by one against all ids used."""
    used = {own for own, _ in rows if own}
    out = []
    for own, slug in rows:
        if own:
            out.append(own)
            continue
        form, k = slug, 2
        while form in used:
            form, k = f"{slug}-{k}", k + 1
        used.add(form)
        out.append(form)
    return out


def test_ids_are_dealt_against_all_used_ids(spark):
    rng = random.Random(3)
    groups = {g: [(rng.choice([None, None, None, "a-3", "b", "x-1"]), rng.choice(["a", "a-2", "a-2-2", "b", "a-02", "c"])) for _ in range(40)] for g in "pqr"}
    groups["one"] = [(None, "z")] * 5
    rows = [(g, i, *r) for g, rs in groups.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(rows, "g string, n long, own string, slug string")
    got = {(r.g, r.n): r.uid for r in R.unique_ids(df, ["g"], "own", "slug", "n").collect()}
    assert got == {(g, i): u for g, rs in groups.items() for i, u in enumerate(deal_brute(rs))}


def test_numbers_of_a_hot_key_go_on_over_its_ranges(spark):
    from studyloom.operators.skew import numbered

    rows = [("hot", (i * 37) % 500) for i in range(500)] + [(None, i) for i in range(120)] + [("few", 3), ("few", 1)]
    got = numbered(spark.createDataFrame(rows, "k string, o long"), ["k"], "o", "n", hot_rows=50).collect()
    assert {(r.k, r.o): r.n for r in got} == {**{("hot", i): i + 1 for i in range(500)}, **{(None, i): i + 1 for i in range(120)}, ("few", 1): 1, ("few", 3): 2}


def test_ancestry_at_any_depth(spark):
    ext = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(40)], "tbl string, parent string")
    cols = spark.createDataFrame([(f"t{i}", f"c{i}", 1, "string") for i in range(41)], "tbl string, col string, pos long, kind string")
    got = R.inherit_columns(cols, ext).filter("tbl = 't0'").orderBy("depth").collect()
    assert [(r.col, r.depth) for r in got] == [(f"c{i}", i) for i in range(41)]


def test_backends_are_dealt_in_turn_across_gaps(spark, tmp_path):
    from studyloom.plans.relational_queries import round_robin

    ids = [i * i * 3 + 7 for i in range(200)]
    spark.createDataFrame([(i,) for i in reversed(ids)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    assert sorted(tuple(r) for r in round_robin(spark, str(tmp_path)).collect()) == [(x, i % 7) for i, x in enumerate(ids)]
    assert R.global_index(spark.createDataFrame([], "event_id long"), "event_id").count() == 0
