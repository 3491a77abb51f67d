import datetime as dt
import random

from studyloom.operators.orphans import NEVER, live_spans, orphan_report, orphans

REF = "tbl string, row_id long, field string, pos long, key string, loaded_at timestamp"
PAR = "key string, loaded_at timestamp, deleted_at timestamp"


def day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def brute(refs, parents):
    out = []
    for i, (k, t) in enumerate(refs):
        own = [p for p in parents if p[0] is not None and p[0] == k]
        if any(a is not None and t is not None and a <= t and (z is None or t < z) for _, a, z in own):
            continue
        seen = any(a is not None and t is not None and a <= t for _, a, _ in own)
        out.append((i, "missing" if not own else "deleted" if seen else "late"))
    return sorted(out)


def check(spark, refs, parents, size):
    r = spark.createDataFrame([("t", i, "f", 1, k, day(t)) for i, (k, t) in enumerate(refs)], REF)
    p = spark.createDataFrame([(k, day(a), day(z)) for k, a, z in parents], PAR)
    got = sorted((x.row_id, x.reason) for x in orphans(r, p, size).collect())
    assert got == brute(refs, parents)


def test_each_reason_and_edges(spark):
    parents = [("a", 1, 5), ("a", 3, 8), ("b", 4, None), (None, 0, None), ("c", None, None), ("d", 5, 5), ("e", 1, 2), ("e", 4, None), ("a", 1, 5)]
    refs = [("a", t) for t in (0, 1, 4, 5, 7, 8)] + [("b", 3), ("b", 4), ("x", 1), (None, 1), ("c", 9), ("d", 5), ("e", 2), ("e", 3), ("e", 4), ("a", None), ("a", 1)]
    check(spark, refs, parents, 100)


def test_random_tables_with_a_hot_key_over_many_ranges(spark):
    rng = random.Random(5)
    keys = ["hot"] * 6 + [f"k{i}" for i in range(12)]
    parents = [(rng.choice(keys), a := rng.randrange(200), rng.choice([None, a + rng.randrange(6)])) for _ in range(150)]
    refs = [(rng.choice([*keys, "gone"]), rng.randrange(210)) for _ in range(400)]
    check(spark, refs, parents, 7)


def test_empty_tables(spark):
    check(spark, [], [("a", 1, None)], 10)
    check(spark, [("a", 1)], [], 10)
    check(spark, [], [], 10)


def test_spans_are_disjoint_and_start_with_a_sentinel(spark):
    p = spark.createDataFrame([("a", day(1), day(4)), ("a", day(2), day(6)), ("a", day(6), day(7)), ("a", day(9), None)], PAR)
    spans = sorted((r.start, r.stop) for r in live_spans(p)[0].collect())
    assert spans[0] == (NEVER, NEVER) and len(spans) == 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_report_counts(spark, rows):
    f = spark.createDataFrame([("t", 1, "f", 1, "late", "2024-01"), ("t", 1, "f", 2, "late", "2024-01"), ("t", 2, "f", 1, "missing", "2024-02")], "tbl string, row_id long, field string, pos long, reason string, period string")
    assert rows(orphan_report(f)) == [("t", "f", "2024-01", "late", 2, 1), ("t", "f", "2024-02", "missing", 1, 1)]
