from pyspark.sql import functions as F

from studyloom.operators import sections as S
from studyloom.operators import workbook as V


def test_references_are_resolved_after_values(spark):
    orgs = spark.createDataFrame([(" O1 ", "Alpha"), ("O2", "Beta"), ("O3", "beta!"), (None, "none")], "id string, name string")
    rows = spark.createDataFrame([(1, "7.0", "o1", "alpha; O2; nobody"), (2, "x", "beta", None), (3, None, None, "O2"), (4, "1", '{"id": "O2"}', "")], "k long, n string, org string, orgs string")
    ref = ("orgs", "id", ["id", "name"])
    got = V.fix_tables({"t": rows, "orgs": orgs}, {"t": {"n": "int"}}, {("t", "org"): ref, ("t", "orgs"): ref}, frozenset({("t", "orgs")}))["t"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "7", "O1", "O1,O2"), (2, "", "", ""), (3, "", "", "O2"), (4, "1", "O2", "")]


def test_self_references_contributors_and_schema_rows(spark):
    df = spark.createDataFrame([("a", "a", None), ("b", "c", None), ("d", None, "x")], "id string, org string, other string")
    assert sorted((r.id, r.org, r.other) for r in V.clear_self_references(df, "id", "org", "other", F.col("id") == "b").collect()) == [("a", "", ""), ("b", "", "c"), ("d", "", "x")]
    a, b = spark.createDataFrame([(1, ["o"])], "k long, organisations_involved array<string>"), spark.createDataFrame([(2, ["p"])], "k long, people_involved array<string>")
    assert sorted((r.k, r.organisations_involved, r.people_involved) for r in V.joined_contributors(a, b, "k").collect()) == [(1, ["o"], []), (2, [], ["p"])]
    out = V.schema_rows([df.select("id"), df.select("other", "id")])
    assert out.columns == ["id", "other"] and out.filter("other = ''").count() == 5


def test_blocks_are_put_in_behind_those_before_them(spark):
    blocks = spark.createDataFrame([("t", 1, "Name", "n"), ("t", 2, "Size", "s")], "task string, block long, head string, body string")
    added = spark.createDataFrame([("t", "kind", "k"), ("t", "NAME", "x"), ("t", "odd", "o"), ("t", "first", "f")], "task string, head string, body string")
    order = spark.createDataFrame([("first", 0), ("name", 1), ("kind", 2), ("size", 3)], "head string, rank int")
    assert [r.head for r in V.insert_blocks(blocks, added, order).orderBy("pos").collect()] == ["first", "Name", "kind", "Size", "odd"]


def test_sections_are_repaired_from_the_text_and_each_other(spark):
    schema = ("types array<string>, themes array<string>, laws array<string>, titles array<string>, groups array<string>, areas array<string>, event_areas array<array<string>>, age_min long, number_of_participants long, access_rights string, "
              "access_description string, data_access_fee boolean, linkage_options string, pid string, name string, provenance string, datasets array<string>, samplesets array<string>, sample_types array<string>, t string")
    text = "We found 10.1000/abc.1. About 250 participants will be included. Data are available on request. The Northern cohort dataset and biological samples of blood and DNA."
    row = (["Cohort study"], [], ["A"], ["A title"], ["Adult (18+ years)"], [], [["x", "y"], ["X"], None], 12, None, None, None, True, "registry, mortality; survival data; census", None, "a Title", "Not commissioned", [], [], [], text)
    none = (None,) * 16 + ([], [], []) + (None,)
    got = S.repaired_sections(spark.createDataFrame([row, none], schema), "t").collect()
    r = next(x for x in got if x.types)
    assert (r.age_min, r.number_of_participants, r.access_rights, r.access_description, r.data_access_fee) == (None, 250, "Restricted access", "Data are available on request.", None)
    assert (r.linkage_options, r.pid, r.name, r.provenance, r.themes, r.laws, r.areas) == ("registry; census", "10.1000/abc.1", None, None, ["Health"], ["A", "Data Governance Act"], ["x", "y"])
    assert r.datasets == ["Northern cohort dataset"] and r.samplesets == ["biological samples"] and r.sample_types == ["Blood", "DNA"]
    n = next(x for x in got if not x.types)
    assert n.pid is None and n.datasets == [] and n.areas == [] and n.laws is None
