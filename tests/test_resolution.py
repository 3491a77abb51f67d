import difflib

from pyspark.sql import functions as F

from studyloom.functions.text import geo_key
from studyloom.operators import resolution as Z

ENTRY = "name string, label string, acronym string, code string, ontology_term_uri string, id string"
LIST = [
    ("Oskatt (the)", None, "OSK", "OK", None, "1"), ("Great Ploniro", "Ploniro, great", None, "GP", "urn:p", "2"), ("Northern Haldelmar", None, None, "NH", None, "3"),
    ("Northern Haldelmas", None, None, "NS", None, "4"), ("Dup", "same", None, "D1", None, "5"), ("Dap", "same", None, "D2", None, "6"), ("European Union", None, None, "EUU", None, "7"),
]


def test_choice_stages_methods_and_suggestions(spark):
    entries = spark.createDataFrame(LIST, ENTRY)
    raws = ["Great Ploniro", "great-ploniro!", "osk", "same", "Great Plonirro of the far off shore of the bay", None, " ", "!?", "urn:p", "dup"]
    got = {r.raw: (r.mapped, r.method, r.suggestions) for r in Z.match_values(spark.createDataFrame([(x,) for x in raws], "v string"), "v", Z.choice_stages(entries)).collect()}
    assert got["Great Ploniro"] == ("Great Ploniro", "exact", []) and got["great-ploniro!"][:2] == ("Great Ploniro", "normalized")
    assert got["osk"][:2] == ("Oskatt (the)", "normalized") and got["urn:p"][1] == "exact" and got["dup"][:2] == ("Dup", "normalized")
    assert got["same"][:2] == (None, "unmapped") and got[""][1] == "empty" and got["!?"][1] == "empty_normalized"
    assert got["same"][2] and len(got["same"][2]) <= 5


def test_places_by_brute_force(spark):
    entries = spark.createDataFrame(LIST, ENTRY)
    raws = ["ok", "oskatt", "OSKATT (THE)", "the oskatt", "Northern Haldelmar", "Nørthern Haldelmar", "eu", "Great Plonir", "Great  Ploniro", "nowhere"]
    found = Z.match_values(spark.createDataFrame([(x,) for x in raws], "v string"), "v", Z.place_stages(entries, True), cutoff=0.95)
    got = {r.raw: (r.mapped, r.method) for r in found.collect()}
    keys = {}
    for name in sorted(x[0] for x in LIST):
        k = spark.range(1).select(geo_key(F.lit(name))).first()[0]
        keys.setdefault(k, name)
    score = sorted(((difflib.SequenceMatcher(None, "great plonir", k).ratio(), c) for k, c in keys.items()), reverse=True)
    assert score[0][0] >= 0.95 and got["Great Plonir"] == (score[0][1], "fuzzy_auto")
    assert got["ok"] == ("Oskatt (the)", "code") and got["oskatt"][1] == "normalized_name" and got["OSKATT (THE)"][1] == "exact_name"
    assert got["eu"] == (None, "unmapped") and got["nowhere"] == (None, "unmapped")
    regions = Z.match_values(spark.createDataFrame([("eu",)], "v string"), "v", Z.place_stages(entries, False))
    assert regions.first().mapped == "European Union" and regions.first().method == "alias"


def test_external_organisation_moves_what_has_no_entry(spark):
    rows = spark.createDataFrame([(1, "osk", "x"), (2, "none", None), (3, "none", "Great Ploniro"), (4, None, None), (5, "none", "other")], "k long, organisation string, other string")
    out = Z.external_organisations(rows, "organisation", "other", spark.createDataFrame(LIST, ENTRY))
    assert sorted((r.k, r.organisation, r.other) for r in out.collect()) == [(1, "Oskatt (the)", ""), (2, "", "none"), (3, "Great Ploniro", ""), (4, "", ""), (5, "", "other")]


def stub():
    return lambda prompt: '{"choice": "B"}' if "Value: b" in prompt else '{"choice": "Z"}'


def test_model_chooses_among_suggestions_within_budget(spark):
    left = spark.createDataFrame([("b1", ["A", "B"]), ("b2", ["A", "B"]), ("c", ["A"]), ("b9", ["B"])], "raw string, suggestions array<string>")
    got = {r.raw: (r.choice, r.method) for r in Z.choose_with_model(left, stub, 20, budget=2).collect()}
    assert got == {"b1": ("B", "llm"), "b2": ("B", "llm"), "b9": (None, "unmapped"), "c": (None, "unmapped")}
    assert all(r.choice is None for r in Z.choose_with_model(left, stub, 16).collect())


def test_organisations_source(spark):
    reg = spark.createDataFrame([("Agents", "organisation", "a.csv"), ("Organisations", "organisation", "o.csv"), ("X", "organisation", "x")], "tbl string, col string, source string")
    assert Z.organisations_source(reg).first().source == "o.csv"
