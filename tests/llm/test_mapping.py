import random

from pyspark.sql import functions as F

from studyloom.llm import mapping
from studyloom.llm.placenames import edits, forms, grams, within

PLACES = [
    ("countries", "Gulstunia (the Republic of)", "South Gulstunia", None, "STN"), ("countries", "Gulstunia (the Democratic People's Republic of)", "North Gulstunia", "GDPRIA", "NHT"), ("countries", "Wilsunesh, Kingdom of", "Wilsunesh", None, "WUH"),
    ("countries", "Dokrusora and Nusnasland Islands (the)", "Dokrusora and Nusnasland Islands", "DNIDS", "DKL"), ("countries", "Sumgrônesh (the)", "Sumgrônesh", None, "SOH"), ("regions", "Province of Sagashiré", "Sagashiré", "PSRE", "SA22"), ("regions", "Greater Bugoldal Area", "Greater Bugoldal", "GBAAL", "GR31"),
]
TYPED = [
    ("countries", "the kingdom of wilsunesh", "WUH"), ("countries", "S. Gulstunia", "STN"), ("countries", "Dem. People’s Rep. of Gulstunia", "NHT"), ("countries", "N. Gulstunia ?", "NHT"), ("countries", "G.D.P.R.I.A.", "NHT"), ("countries", "wuh", "WUH"),
    ("countries", "Dokrusora & Nusnaslland Is. (14 sites)", "DKL"), ("countries", "Sumgronesh", "SOH"), ("countries", "Slmgrônesh", "SOH"), ("countries", "Wilsunes,h Kingdom of", "WUH"), ("countries", "mainly Wilsuensh", "WUH"), ("countries", "Sagashiré", None),
    ("countries", "Gulstunia", None), ("countries", "Ydrerolfaryth", None), ("countries", "see protocol", None), ("countries", "-", None), ("regions", "Prov. Sagashire", "SA22"), ("regions", "Bugoldal metropolitan area", "GR31"), ("regions", "sa22", "SA22"), ("regions", "Sagashire Sagashire " * 300, None),
]
ENTRY = "field string, name string, label string, acronym string, code string"


def test_typed_values(spark):
    entries = spark.createDataFrame([*PLACES, PLACES[0], ("countries", "Nocode", None, None, None)], ENTRY)
    values = spark.createDataFrame([(f, v) for f, v, _ in TYPED] * 2, "field string, val string")
    got = {(r.field, r.val): r.code for r in mapping.map_values(values, entries).collect()}
    assert got == {(f, v): c for f, v, c in TYPED}
    assert all(r.code is None for r in mapping.map_values(values, entries.limit(0)).collect())
    assert mapping.map_values(values.limit(0), entries).count() == 0


def test_prefix_filter_join_loses_no_pair(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(70)]
    a, b = words[:40], words[40:]
    frame = lambda ws: spark.createDataFrame([("f", "n", w, grams(w)) for w in dict.fromkeys(ws)], "field string, kind string, form string, grams array<string>")
    got = {(r.form, r.other) for r in mapping.similar_forms(frame(a), frame(b), 0.4).collect()}
    jac = lambda x, y: len(set(grams(x)) & set(grams(y))) / len(set(grams(x)) | set(grams(y)))
    assert got == {(x, y) for x in a for y in b if jac(x, y) >= 0.4}


def test_edits():
    assert within("abcd", "abdc", 1) == 1 and within("abc", "xyz", 1) == 2 and edits("gulstunia north", "gulstunia south") == -1 and edits("a", "b") == -1 and edits("x y", "x y") == 0
    assert forms("  ") == [] and forms("overseas") == []


def test_catalogue_and_correction(spark, rows):
    res = spark.createDataFrame([(1, "wuh; Wilsunesh;;x9", None, "l"), (2, None, " ", "l")], "row_id long, countries string, regions string, lst string")
    m = spark.createDataFrame([(5, "regions", "Sagashire", "Wrong"), (6, "countries", "nowhere", "Wrong"), (7, "countries", None, None), (8, "other", "x", None)], "match_id long, field string, raw string, mapped string")
    c = spark.createDataFrame([p[1:] for p in PLACES if p[0] == "countries"], "name string, label string, acronym string, code string")
    r = spark.createDataFrame([p[1:] for p in PLACES if p[0] == "regions"], "name string, label string, acronym string, code string")
    got = mapping.mapped_places(res, m, c, r).select("tbl", "row_id", "field", "pos", "code")
    assert rows(got) == sorted([("resources", 1, "countries", 1, "WUH"), ("resources", 1, "countries", 2, "WUH"), ("resources", 1, "countries", 3, None), ("choice_matches", 5, "raw", 1, "SA22"), ("choice_matches", 6, "raw", 1, None)], key=repr)
    fixed = {x.match_id: (x.corrected, x.verdict) for x in mapping.corrected_matches(res, m, c, r).collect()}
    assert fixed == {5: ("Province of Sagashiré", "changed"), 6: (None, "withdrawn"), 7: (None, "unmatched"), 8: (None, "unmatched")}
    assert got.filter(F.col("row_id") == 2).count() == 0


def test_no_pair_within_the_allowed_edits_is_lost(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (4, 4, 5, 5, 6, 8, 9, 9, 10, 12)]
    names = [*words, *(" ".join(sorted(rng.sample(words, 2))) for _ in range(8))]

    def typo(w: str) -> str:
        i = rng.randrange(len(w) - 1)
        return rng.choice((w[:i] + w[i + 1] + w[i] + w[i + 2 :], w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :]))

    typed = [t for w in names for _ in range(12) for t in (typo(w), typo(typo(w)), w.replace(" ", ""))]
    frame = lambda ws: spark.createDataFrame([("f", "n", w, grams(w)) for w in dict.fromkeys(ws) if w.strip()], "field string, kind string, form string, grams array<string>")
    got = {(r.form, r.other) for r in mapping.similar_forms(frame(typed), frame(names)).collect()}
    assert {(a, b) for a in typed for b in names if edits(a, b) >= 0} <= got


def test_swaps_in_short_names_are_found(spark):
    entries = spark.createDataFrame([("countries", "Tervo", None, None, "TV"), ("countries", "Kilm", None, None, "KM"), ("countries", "Dosrubane", None, None, "DB")], ENTRY)
    typed = {"Trevo": "TV", "Klim": "KM", "Dosurbaen": "DB", "Tevro": "TV", "Kxxm": None}
    values = spark.createDataFrame([("countries", v) for v in typed], "field string, val string")
    assert {r.val: r.code for r in mapping.map_values(values, entries).collect()} == typed
