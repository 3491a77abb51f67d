from collections import Counter

from studyloom.llm import names
from studyloom.llm.nameparts import Channel, evidence_of, person_tokens, shortening

ORG = "row_id long, name string, organisation string, kind string"
PER = "row_id long, first_name string, last_name string, entity string"


def links(pairs, kind):
    return {(r.row_a, r.row_b) for r in pairs.collect() if r.kind == kind}


def channel(*writings):
    rows = [e for w in writings for e in evidence_of(w)]
    listed, runs = Counter(k for k, kinds in rows if not kinds), Counter((k, kinds) for k, kinds in rows if kinds)
    initials = {}
    for (k, kinds), n in sorted(runs.items(), key=lambda x: (-x[1], x[0])):
        initials.setdefault(k, (kinds, n))
    return Channel(listed, initials, len(writings))


WRITINGS = [f"{kind} {place}" for place in ("Telwamtaltrom", "Kosrelmanhus", "Rivumstanden", "Skanwunfamsim") for kind in (
    "University of", "Kosrel University Medical Centre", "Institute of Public Health", "Ministry of Health of", "Heart Foundation", "Institute of Technology", "Cancer Centre", "Department of Epidemiology")]


def test_parts():
    body_parts = channel(*WRITINGS).body_parts
    assert body_parts("Univ. of Telwamtaltrom")[1] == body_parts("Universität Telwamtaltrom")[1] == "university"
    assert body_parts("UMC Kosrel")[1] == body_parts("Kosrel University Medical Centre")[1] == "medical university"
    assert body_parts("Data Office") == ("", "") and body_parts("Ministry of Health of Xylanda") == ("xylanda", "health ministry")
    assert person_tokens(None, "Dr R. Nimwir") == (["r"], [["nimwir"]]) and person_tokens("", "Bask-Bom, Ann") == (["ann"], [["bask", "bom"]])
    assert person_tokens(None, None) == ([], []) and person_tokens("T.B.", "van Has") == (["t", "b"], [["has"]])


def test_abbreviations_are_told_by_their_likelihood_alone():
    c = channel(*WRITINGS)
    for short, kinds in {"Inst. Publ. Hlth": "health public", "IPH": "health public", "MoH": "health ministry", "Univ": "university", "Tech": "technology", "Heart Fdn": "heart", "Dept. of Cancer": "cancer", "Cancer Ctr.": "cancer", "Bio-Bank": "biobank"}.items():
        assert c.body_parts(f"{short} Kromdrumhil") == ("kromdrumhil", kinds), short
    assert c.body_parts("Zark Kromdrumhil Biobank") == ("zarkkromdrumhil", "biobank") and c.body_parts("Uni") == ("", "university")
    assert shortening("health", "hlth") > shortening("health", "hth") and shortening("university", "tech") == float("-inf")
    assert shortening("university", "univ") > shortening("university", "unvst") > float("-inf") == shortening("a", "a")


def test_short_words_two_typos_and_long_chains(spark):
    words = [("p", "bonn", 100), ("p", "bonm", 1), ("p", "groningen", 100), ("p", "grunignen", 1), ("p", "dom", 4), ("p", "tom", 90)]
    chain = [("q", w, n) for w, n in (("abcdefghij", 10**15), ("abcdefghiz", 10**12), ("abcdefghyz", 10**9), ("abcdefgxyz", 10**6), ("abcdefwxyz", 10**3), ("abcdevwxyz", 1))]
    got = {r.word: r.canon for r in names.attach_variants(spark.createDataFrame(words + chain, "space string, word string, n long"), frozenset({"dom"})).collect()}
    assert got["bonm"] == "bonn" and got["grunignen"] == "groningen" and got["dom"] == "dom"
    assert {got[w] for _, w, _ in chain} == {"abcdefghij"}


def test_organisations(spark):
    o = [
        (1, None, "Kusstesskaslol Cancer Centre", "x"), (2, "Cancer Ctr. Kusstesskaslol", None, "x"), (3, "unit", "KUSSTESSKASLOL cancer center", "x"), (4, None, "Kusstessakslol Cancer Centre", "x"),
        (5, None, "Kusstesskaslol Heart Foundation", "x"), (6, "Data Office", " ", "x"), (7, None, None, "x"), (8, None, "Kusstesskaslol Cancer Centre", "x"), (9, None, "Rivumstanden Cancer Centre", "x"),
    ]
    c = spark.createDataFrame([], PER.replace("entity", "organisation"))
    got = links(names.linked_pairs(spark.createDataFrame(o, ORG), c), "organisation")
    own = (1, 2, 3, 4, 8)
    assert got == {(a, b) for a in own for b in own if a < b} - {(1, 8)}


def test_people(spark):
    c = [
        (1, "Elizabeth", "Basskersrur", "e"), (2, "Liz", "Basskersrur", "e"), (3, "E.", "Basskersrur", "e"), (4, None, "Basskersrur, Elizabeth", "e"), (5, "Basskersrur", "Elizabeth", "e"), (6, "Elizabth", "Bassekrsrur", "e"),
        (7, "Elizabeth", "Basskersrur-Komlan", "e"), (8, "Margaret", "Basskersrur", "e"), (9, None, "Basskersrur", "e"), (10, "", " ", "e"), (11, "Elizabeth", "Kromdrumhil", "e"), (12, "Margaret", "Kromdrumhil", "e"), (13, "Elizabeth", "Vuldrukilim", "e"),
    ]
    o = spark.createDataFrame([], ORG)
    got = links(names.linked_pairs(o, spark.createDataFrame(c, PER)), "contact")
    assert got == {(a, b) for a in range(1, 8) for b in range(1, 8) if a < b}


def test_a_frequent_neighbour_is_a_name_of_its_own():
    assert names.log_odds(40, 1, 12) > 0 > names.log_odds(40, 35, 12)


def test_empty_and_repeated(spark):
    o, c = spark.createDataFrame([], ORG), spark.createDataFrame([], PER)
    assert names.linked_pairs(o, c).count() == 0 and names.entities(o, c).count() == 0
    twice = spark.createDataFrame([(1, None, "Rivumstanden Biobank", ""), (2, None, "Rivumstanden Biobank", "")], ORG)
    assert names.linked_pairs(twice, c).count() == 0 and {r.n_rows for r in names.entities(twice, c).collect()} == {2}


def test_blocks_of_a_hot_writing_give_all_pairs(spark):
    o = spark.createDataFrame([(i, None, "Rivumstanden Biobank" if i % 10 else "Biobank of Rivumstanden" if i % 20 else "RIVUMSTANDEN BIOBANK", "") for i in range(60)], ORG)
    got = links(names.linked_pairs(o, spark.createDataFrame([], PER), block=4), "organisation")
    kind = lambda i: "plain" if i % 10 else i % 20
    assert got == {(a, b) for a in range(60) for b in range(a + 1, 60) if kind(a) != kind(b)}


def test_a_share_of_typos_counts_alike_at_any_size(spark):
    for times in (1, 10, 100):
        assert names.log_odds(83 * times, 2 * times, 6) > 0 > names.log_odds(40 * times, 35 * times, 12), times
        assert all(names.log_odds(*names.evidence(4 * times, times, 4, 1), n) > 0 for n in (8, 12)), times  # copies
    for length in (5, 6, 7, 8, 12):
        assert all(names.log_odds(n, 1, length) > 0 for n in (100, 10_000, 1_000_000)), length
    words = [("p", "ursula", 83), ("p", "urula", 2), ("p", "vuldruki", 68_000), ("p", "vuldrukki", 1), ("p", "vuldruky", 30_000)]
    got = {r.word: r.canon for r in names.attach_variants(spark.createDataFrame(words, "space string, word string, n long")).collect()}
    assert got == {"ursula": "ursula", "urula": "ursula", "vuldruki": "vuldruki", "vuldrukki": "vuldruki", "vuldruky": "vuldruky"}


def test_no_side_that_grows_is_broadcast_through_the_driver(spark, monkeypatch):
    """Joins are planned alike whatever the planner takes for small: only the bounded tables that the code names are broadcast."""
    plans = []

    def kept(df, cut=names.cut):
        out = cut(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return out

    monkeypatch.setattr(names, "cut", kept)
    o = spark.createDataFrame([(i, None, w, "") for i, w in enumerate(WRITINGS * 2 + [w.replace("mwam", "mwm").lower() for w in WRITINGS])], ORG)
    c = spark.createDataFrame([(1, "Elizabeth", "Basskersrur", ""), (2, "Liz", "Basskersrur", ""), (3, "Elizabth", "Bassekrsrur", "")], PER)
    got, usual = {}, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in ("-1", "1g"):
        plans.clear()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            pairs = names.linked_pairs(o, c)
            linked = sorted(map(tuple, pairs.collect()))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
        plans.append(pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        got[threshold] = ([p.count("BroadcastExchange") for p in plans], linked)
    assert got["-1"] == got["1g"] and len(got["1g"][1]) > 3
