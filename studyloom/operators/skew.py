"""Joins that stay balanced when one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from studyloom.session import cut, parallelism

HOT_SHARE = 1000  # a key is hot if it has more than 1 / HOT_SHARE of the rows, so at most HOT_SHARE keys are
HOT_ROWS = 100_000  # and at least so many


def by_sort(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the data. The planner takes sizes from the files and does not see what is packed in them or
    exploded later, so it would broadcast such a side through the driver; by sorting, nothing of it gets there."""
    return df.hint("merge")


def join_hot(rows: DataFrame, mapped: DataFrame, keys: list[str], counts: DataFrame, n: str = "n") -> DataFrame:
    """Left join of rows with mapped (one row per key); counts: rows per key. Hot keys, at most HOT_SHARE, go by broadcast."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = counts.filter(F.col(n) > max(total / HOT_SHARE, HOT_ROWS)).select(*keys)
    few = mapped.join(F.broadcast(hot), keys, "left_semi").withColumn("__hot", F.lit(True))
    tried = rows.join(F.broadcast(few), keys, "left")
    rest = tried.filter("__hot IS NULL").select(*rows.columns).join(mapped, keys, "left")
    return tried.filter("__hot").drop("__hot").unionByName(rest)


def self_pairs(members: DataFrame, group: list[str], item: str, keep: list[str], block: int = 2000) -> DataFrame:
    """Pairs (item_a < item_b, and keep_a, keep_b) within each group; large groups are cut into blocks of rows, so that no
    task holds a whole group: the left side of a group is spread over its blocks, the right side is repeated in each."""
    sizes = members.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("__blocks")).filter("__blocks >= 1")
    m = members.join(by_sort(sizes), group)
    left = m.select(*group, F.pmod(F.xxhash64(item), F.col("__blocks")).alias("__b"), *[F.col(c).alias(f"{c}_a") for c in [item, *keep]])
    right = m.select(*group, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)).alias("__b"), *[F.col(c).alias(f"{c}_b") for c in [item, *keep]])
    return left.join(by_sort(right), [*group, "__b"]).filter(F.col(f"{item}_a") < F.col(f"{item}_b")).drop("__b")


def numbered(df: DataFrame, keys: list[str], order: str, into: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows numbered from 1 in order within their key. The rows of a hot key are cut into ranges of the order, numbered in each and
    moved on by the sizes of the ranges before, so that no task holds a hot key."""
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    sizes = cut(counts.filter(F.col("__n") > hot_rows))  # few keys: each has at least so many rows
    if sizes.isEmpty():
        return df.withColumn(into, plain)
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    hot = F.broadcast(sizes.orderBy(F.desc("__n")).limit(HOT_SHARE).select(*keys))
    rest = df.alias("r").join(hot.alias("h"), same, "left_anti").withColumn(into, plain)
    ranged = df.alias("r").join(hot.alias("h"), same, "left_semi").repartitionByRange(parallelism(df.sparkSession) * 2, *keys, order)
    ranged = cut(ranged.withColumn("__part", F.spark_partition_id()))
    per = ranged.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__m"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(*keys, "__part", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__base"))
    own = ranged.withColumn("__own", F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(order)))
    meet = [*[F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], F.col("r.__part") == F.col("b.__part")]
    # One row a hot key and range: at most HOT_SHARE keys over the ranges.
    done = own.alias("r").join(F.broadcast(base.alias("b")), meet).select(*[F.col(f"r.`{c}`") for c in df.columns], (F.col("r.__own") + F.col("b.__base")).cast("int").alias(into))
    return rest.unionByName(done)
