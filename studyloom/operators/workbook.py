"""A set of tables as one workbook: two-pass fixing, sections of two states, block edits, schema rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studyloom.functions import coercion as N
from studyloom.functions.arrays import csv_join, parse_list_loose, scalar_of
from studyloom.functions.text import norm_key
from studyloom.operators import relational as R
from studyloom.session import strip


def _clean(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def fix_tables(tables: dict[str, DataFrame], kinds: dict[str, dict[str, str]], refs: dict[tuple[str, str], tuple[str, str, list[str]]], arrays: frozenset[tuple[str, str]] = frozenset()) -> dict[str, DataFrame]:
    """M15. First pass: every column of a known kind is coerced. Second pass: each reference (table, column) is resolved to the id
    of the fixed target (table, id column, token columns) whose token it is, exactly or by letters and digits, if that is one id
    only; else it becomes "". References named in ``arrays`` hold several tokens: those that are not found are dropped.

    Columns of neither kind stay as they are (also references without a target)."""
    first = {name: N.normalize_table(df, kinds.get(name, {})) for name, df in tables.items()}
    out = dict(first)
    for (name, col), (target, key, tokens) in refs.items():
        rows = first[target].withColumn(key, _clean(F.col(key))).filter(F.col(key) != "")
        stages = [("exact", R.unambiguous_index(rows, key, tokens, _clean), _clean), ("normalized", R.unambiguous_index(rows, key, tokens, norm_key), norm_key)]
        df = out[name]
        if (name, col) in arrays:
            values = df.select(F.col(col).alias("__cell")).distinct()
            long = values.select("__cell", F.posexplode(parse_list_loose(F.col("__cell"))).alias("__p", "__raw"))
            hit = R.resolve(long, "__raw", stages, into="__hit").filter("__hit IS NOT NULL").groupBy("__cell", "__hit").agg(F.min("__p").alias("__p"))
            cell = hit.groupBy("__cell").agg(csv_join(F.transform(F.array_sort(F.collect_list(F.struct("__p", "__hit"))), lambda s: s["__hit"])).alias("__new"))
            met = df.join(cell, F.col(col) == F.col("__cell"), "left")
        else:
            values = df.select(F.col(col).alias("__cell")).filter("__cell IS NOT NULL").distinct()
            found = R.resolve(values.withColumn("__raw", scalar_of(F.col("__cell"))), "__raw", stages, into="__new").select("__cell", "__new")
            met = df.join(found, F.col(col) == F.col("__cell"), "left")
        out[name] = met.withColumn(col, F.coalesce("__new", F.lit(""))).select(*[F.col(f"`{c}`") for c in df.columns])
    return out


def clear_self_references(df: DataFrame, key: str, ref: str, other: str | None = None, moves: Column | None = None) -> DataFrame:
    """A reference to the row itself becomes ""; where ``moves`` holds, the reference goes to ``other`` (if that is blank)."""
    out = df.withColumn(ref, F.when(_clean(F.col(ref)) == _clean(F.col(key)), "").otherwise(F.coalesce(ref, F.lit(""))))
    if other is None or moves is None:
        return out
    moved = moves & (F.col(ref) != "")
    return out.withColumn(other, F.when(moved & (_clean(F.col(other)) == ""), F.col(ref)).otherwise(F.coalesce(other, F.lit("")))).withColumn(ref, F.when(moved, "").otherwise(F.col(ref)))


def joined_contributors(core: DataFrame, people: DataFrame, key: str, lists: tuple[str, str] = ("organisations_involved", "people_involved")) -> DataFrame:
    """(key, organisations, people) of two partial results; a missing list is an empty one."""
    a, b = core.select(key, lists[0]), people.select(key, lists[1])
    kinds = dict(a.dtypes) | dict(b.dtypes)
    both = a.join(b, key, "full_outer")
    return both.select(key, *[F.coalesce(c, F.array().cast(kinds[c])).alias(c) for c in lists])


def merge_sections(old: DataFrame, new: DataFrame) -> DataFrame:
    """(task, action, body) of the sections of two states: "kept" if only the old one has it, "new" if only the new one,
    "same" if the bodies are equal, else "merged" (the new body counts)."""
    o, n = old.select("task", F.col("body").alias("o"), F.lit(True).alias("ho")), new.select("task", F.col("body").alias("n"), F.lit(True).alias("hn"))
    both = o.join(n, "task", "full_outer")
    action = F.when(F.col("ho").isNull(), "new").when(F.col("hn").isNull(), "kept").when(F.col("o").eqNullSafe(F.col("n")), "same").otherwise("merged")
    return both.select("task", action.alias("action"), F.when(F.col("hn").isNull(), F.col("o")).otherwise(F.col("n")).alias("body"))


def insert_blocks(blocks: DataFrame, added: DataFrame, order: DataFrame) -> DataFrame:
    """(task, pos, head, body): blocks of a text with those of ``added`` (task, head, body) that it lacks put in behind the last
    block that stands before them in ``order`` (head, rank), compared by letters and digits; unknown heads go to the end."""
    k = lambda c: norm_key(F.col(c)).alias("k")
    ranks = order.select(k("head"), "rank").groupBy("k").agg(F.min("rank").alias("rank"))
    have = blocks.select("task", "block", "head", "body", k("head"))
    more = added.select("task", "head", "body", k("head")).join(have.select("task", "k"), ["task", "k"], "left_anti").join(ranks, "k", "left")
    placed = have.join(ranks, "k", "left")
    # The blocks of a task are few: as many as a text has headings.
    before = more.join(placed.select("task", F.col("rank").alias("r"), F.col("block").alias("b")), "task", "left")
    at = before.groupBy("task", "k", "head", "body", "rank").agg(
        F.max(F.when(F.col("r") < F.col("rank"), F.col("b"))).alias("low"), F.max("b").alias("top"), F.min("b").alias("first")
    )
    where = F.when(F.col("rank").isNull(), F.col("top")).otherwise(F.coalesce(F.col("low"), F.col("first") - 1, F.lit(0)))
    both = have.select("task", F.col("block").alias("at"), F.lit(-1).alias("rank"), "head", "body").unionByName(at.select("task", where.alias("at"), F.coalesce("rank", F.lit(2**30)).alias("rank"), "head", "body"))
    pos = F.row_number().over(Window.partitionBy("task").orderBy("at", "rank", "head"))
    return both.select("task", pos.alias("pos"), "head", "body")


def schema_rows(parts: list[DataFrame]) -> DataFrame:
    """K4: rows of all model files under the union of their headers in first-seen order, missing values ""."""
    names = list(dict.fromkeys(c for p in parts for c in p.columns))
    out = None
    for p in parts:
        one = p.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in p.columns else F.lit("").alias(c) for c in names])
        out = one if out is None else out.unionByName(one)
    return out
