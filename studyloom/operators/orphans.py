"""References to records that do not exist, reported per table and period (problem 7).

Method: keys are range-partitioned; the parents of a range are stored as sorted arrays; the references of the range are
probed against them in vectorised batches by binary search; misses are aggregated.

A parent row is live from ``loaded_at`` (inclusive) to ``deleted_at`` (exclusive). The live times of a key are merged to
disjoint spans, and a sentinel before all spans marks that the key exists, so the last entry at or before (key, time)
tells all: another key - missing; the sentinel - late; a span that has ended - deleted; else live. Ranges are even ranges of
the keys' hashes, so no bound is sampled or kept anywhere. A parent key with more rows than a range is cut further by time; an
entry is repeated in every later part up to the key's next entry. The references of a range are cut into blocks; how many
follows from a counted sample of the references, which sets the balance of tasks only, never a result.

Defined results: blank references are none; a reference or parent without key part is never equal to anything (a null
resource is a missing target); a null ``loaded_at`` of a parent counts as never loaded (the row exists, so its
references are late), of a reference as before every load; repeated rows give repeated results; empty tables work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studyloom.operators.multivalue import explode_values
from studyloom.session import blank, cut, key_norm

NEVER = -(2**63)  # time of the sentinel
FOREVER = 2**63 - 1
RANGE_ROWS = 100_000  # parents of a range, references of a block
SHARE = 64  # one reference in so many is counted to find the blocks
MOST_PARTS = 256  # parts of one key by time
REASONS = pa.array(["live", "missing", "deleted", "late"])


def _micros(col):
    return F.unix_micros(col.cast("timestamp"))


def hot_parents(once: DataFrame, range_rows: int) -> DataFrame | None:
    """(h, key, cuts) of the keys with more entries than a range, with the times at which they are cut; None if there are none."""
    many = cut(once.groupBy("h", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > range_rows).select("h", "key"))
    if many.isEmpty():
        return None
    shares = [k / MOST_PARTS for k in range(1, MOST_PARTS)]
    cuts = once.join(many, ["h", "key"]).groupBy("h", "key").agg(F.array_distinct(F.percentile_approx("start", shares, 10_000)).alias("cuts"))
    return cut(cuts)


def _part(df: DataFrame, t: str, hot: DataFrame | None, into: str = "part") -> DataFrame:
    """The part by time of each (h, key, t): the number of cuts of its key at or before t; 0 for other keys."""
    if hot is None:
        return df.withColumn(into, F.lit(0))
    at = F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col(t))), F.lit(0))
    return df.join(hot, ["h", "key"], "left").withColumn(into, F.when(F.col("cuts").isNull(), 0).otherwise(at)).drop("cuts")


def live_spans(parents: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """((h, key, start, stop): the disjoint live spans of each key with its sentinel; the hot keys). parents: key, loaded_at, deleted_at.

    The running greatest stop of a hot key is taken in its parts by time and carried over from the parts before.
    """
    rows = parents.filter("key IS NOT NULL").select(
        "key", F.xxhash64("key").alias("h"),
        F.coalesce(_micros(F.col("loaded_at")), F.lit(FOREVER)).alias("start"),
        F.coalesce(_micros(F.col("deleted_at")), F.lit(FOREVER)).alias("stop"),
    )
    # Map-side combine: repeated parents collapse before the shuffle. The span of a row deleted before it was loaded is empty, but the row was loaded.
    once = cut(rows.groupBy("h", "key", "start").agg(F.greatest(F.max("stop"), "start").alias("stop")))
    hot = hot_parents(once, range_rows)
    by = ["h", "key", "part"]
    own = Window.partitionBy(*by).orderBy("start")
    before, upto = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    parts = Window.partitionBy("h", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fresh = _part(once, "start", hot)
    latest = F.coalesce(F.max("stop").over(before), F.lit(NEVER))
    if hot is not None:
        carried = fresh.join(hot.select("h", "key"), ["h", "key"]).groupBy(*by).agg(F.max("stop").alias("m")).select(*by, F.max("m").over(parts).alias("carried"))
        fresh = fresh.join(carried, by, "left")
        latest = F.greatest(latest, F.coalesce("carried", F.lit(NEVER)))
    fresh = fresh.withColumn("new", (latest < F.col("start")).cast("long"))
    spans = fresh.withColumn("span", F.sum("new").over(upto))
    if hot is not None:
        spans = cut(spans)
        ahead = spans.join(hot.select("h", "key"), ["h", "key"]).groupBy(*by).agg(F.sum("new").alias("m")).select(*by, F.sum("m").over(parts).alias("ahead"))
        spans = spans.join(ahead, by, "left").withColumn("span", F.col("span") + F.coalesce("ahead", F.lit(0)))
    merged = spans.groupBy("h", "key", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    sentinel = once.select("h", "key").distinct().select("h", "key", F.lit(NEVER).alias("start"), F.lit(NEVER).alias("stop"))
    return merged.filter(F.col("start") < FOREVER).select("h", "key", "start", "stop").unionAll(sentinel), hot


def _probe(left: pa.Table, right: pa.Table) -> pa.Table:
    """Misses among the references of a block: one binary search of (h, t) over the sorted entries of the range."""
    right = right.take(pc.sort_indices(right, [("h", "ascending"), ("key", "ascending"), ("start", "ascending")]))
    rh, rs, re_ = (right[c].to_numpy() for c in ("h", "start", "stop"))
    h, t = left["h"].to_numpy(), left["t"].to_numpy()
    code = np.ones(len(h), "int8")
    if len(rh) and len(h):
        rk, key = right["key"].combine_chunks(), left["key"].combine_chunks()
        lo, hi = np.searchsorted(rh, h, "left"), np.searchsorted(rh, h, "right")
        full = hi > lo
        first, last = np.minimum(lo, len(rh) - 1), np.maximum(hi - 1, 0)
        same = lambda a, b: pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
        clash = full & ~same(rk.take(pa.array(first)), rk.take(pa.array(last)))  # two keys with one hash
        plain = full & ~clash & same(rk.take(pa.array(first)), key)
        # Predecessor of (h, t): one binary search in all slices at once.
        low, high = lo.copy(), hi.copy()
        while (open_ := low < high).any():
            mid = (low + high) // 2
            below = open_ & (rs[np.minimum(mid, len(rs) - 1)] <= t)
            low = np.where(below, mid + 1, low)
            high = np.where(open_ & ~below, mid, high)
        at = np.maximum(low - 1, 0)
        code[plain] = np.where(rs[at] == NEVER, 3, np.where(t < re_[at], 0, 2))[plain]
        for j in np.nonzero(clash)[0]:
            own = np.array([i for i in range(lo[j], hi[j]) if rk[i].as_py() == key[int(j)].as_py()])
            if len(own):
                k = own[max(np.searchsorted(rs[own], t[j], "right") - 1, 0)]
                code[j] = 3 if rs[k] == NEVER else 0 if t[j] < re_[k] else 2
    out = left.drop_columns(["h", "t", "rng", "part", "block", "key"]).append_column("reason", REASONS.take(pa.array(code)))
    return out.filter(pa.array(code != 0))


def misses(refs: DataFrame, parents: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """References (all columns but key) without a live target, with ``reason`` (missing, deleted, late).

    refs has key and loaded_at; parents: key, loaded_at, deleted_at.
    """
    found, hot = live_spans(parents, range_rows)
    spans = cut(found)
    n_ranges = max(1, -(-spans.count() // range_rows))
    # Hashes are even over 64 bits, so even ranges of them hold as many keys each.
    rng = F.expr(f"shiftrightunsigned(h, 1) div {2**63 // n_ranges + 1}") if n_ranges > 1 else F.lit(0).cast("long")
    following = Window.partitionBy("h", "key").orderBy("start")
    stored = _part(spans, "start", hot).withColumn("rng", rng)
    if hot is not None:
        own = stored.join(hot.select("h", "key", F.size("cuts").alias("most")), ["h", "key"], "left")
        own = own.withColumn("last", F.coalesce(F.lead("part").over(following), "most", F.lit(0)))
        stored = own.withColumn("part", F.explode(F.sequence("part", "last"))).drop("most", "last")
    keyed = refs.withColumn("h", F.coalesce(F.xxhash64("key"), F.lit(0))).withColumn("t", F.coalesce(_micros(F.col("loaded_at")), F.lit(NEVER)))
    probes = _part(keyed, "t", hot).withColumn("rng", rng)
    counted = probes.filter(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in refs.columns if c != "key"]), F.lit(SHARE)) == 0)
    sizes = cut(counted.groupBy("rng", "part").agg(F.ceil(F.count(F.lit(1)) * SHARE / range_rows).cast("long").alias("blocks")))
    probes = probes.join(sizes, ["rng", "part"], "left").fillna(1, ["blocks"])
    probes = probes.withColumn("block", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in refs.columns]), F.col("blocks"))).drop("blocks")
    stored = stored.join(sizes, ["rng", "part"], "left").fillna(1, ["blocks"])
    stored = stored.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    by = ["rng", "part", "block"]
    schema = ", ".join(f"`{n}` {t}" for n, t in refs.dtypes if n != "key") + ", reason string"
    return probes.groupBy(*by).cogroup(stored.groupBy(*by)).applyInArrow(_probe, schema)


def _pair(resource, name):
    """Composite key; null if the name is blank (a blank resource matches nothing but itself is kept)."""
    return F.when(~blank(name), F.concat(F.coalesce(key_norm(resource), F.lit("\u0000")), F.lit("\u0001"), key_norm(name)))


def catalogue_references(counts: DataFrame, events: DataFrame, resources: DataFrame) -> DataFrame:
    """(tbl, row_id, field, pos, key, loaded_at) of every non-blank reference; keys carry the kind of their target."""

    def scalar(df: DataFrame, tbl: str, field: str, key) -> DataFrame:
        return df.filter(~blank(F.col(field))).select(
            F.lit(tbl).alias("tbl"), "row_id", F.lit(field).alias("field"), F.lit(1).cast("long").alias("pos"), key.alias("key"), "loaded_at"
        )

    own = F.concat(F.lit("s\u0001"), _pair(F.col("resource"), F.col("subpopulation")))
    several = explode_values(events, "collection_events", "row_id", "subpopulations", ("resource", "loaded_at")).select(
        "tbl", "row_id", "field", "pos", F.concat(F.lit("s\u0001"), _pair(F.col("resource"), F.col("val"))).alias("key"), "loaded_at"
    )
    return (
        scalar(counts, "subpopulation_counts", "subpopulation", own)
        .unionAll(several)
        .unionAll(scalar(resources, "resources", "contact_point", F.concat(F.lit("c\u0001"), key_norm(F.col("contact_point")))))
        .unionAll(scalar(resources, "resources", "publisher", F.concat(F.lit("o\u0001"), key_norm(F.col("publisher")))))
    )


def catalogue_targets(subpopulations: DataFrame, organisations: DataFrame, contacts: DataFrame) -> DataFrame:
    """(key, loaded_at, deleted_at) of every row that can be referred to."""
    subs = subpopulations.filter("resource IS NOT NULL").select(
        F.concat(F.lit("s\u0001"), _pair(F.col("resource"), F.col("name"))).alias("key"), "loaded_at", "deleted_at"
    )
    orgs = organisations.filter(~blank(F.col("id"))).select(F.concat(F.lit("o\u0001"), key_norm(F.col("id"))).alias("key"), "loaded_at", "deleted_at")
    people = contacts.filter(~blank(F.col("contact_code"))).select(
        F.concat(F.lit("c\u0001"), key_norm(F.col("contact_code"))).alias("key"), "loaded_at", "deleted_at"
    )
    return subs.unionAll(orgs).unionAll(people).filter("key IS NOT NULL")


def orphans(refs: DataFrame, targets: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(tbl, row_id, field, pos, reason, period) of every reference without a live target."""
    found = misses(refs, targets, range_rows)
    return found.select("tbl", "row_id", "field", "pos", "reason", F.date_format("loaded_at", "yyyy-MM").alias("period"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphan references counted per table, field, period and reason."""
    return found.groupBy("tbl", "field", "period", "reason").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("row_id").alias("n_rows"))
