"""Registry of tables and columns from model files.

A model row has tableName, tableExtends, columnName and further columns; ``file`` and ``pos`` give its place. Everything is a
DataFrame of (tbl, col) rows; lists of values are joined by their source.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.functions.arrays import parse_list
from studyloom.functions.text import norm_key
from studyloom.operators.relational import inherit_columns
from studyloom.session import strip


def _clean(c: str) -> Column:
    return strip(F.coalesce(F.col(c), F.lit("")))


def table_names(rows: DataFrame) -> DataFrame:
    """M3: (tbl, pos) of the tables, each at its first place."""
    named = rows.select(_clean("tableName").alias("tbl"), "pos").filter("tbl <> ''")
    return named.groupBy("tbl").agg(F.min("pos").alias("pos"))


def source_of(kind: Column, ref_table: Column) -> Column:
    """M3: the list that an ontology column takes its values from; null for other columns."""
    return F.when(F.lower(kind).startswith("ontology") & (ref_table != ""), ref_table)


def registry(rows: DataFrame, choices: DataFrame | None = None) -> DataFrame:
    """M1: (tbl, col, pos, kind, defined_in, direct, source, n_allowed): the columns of each table with those of its ancestors, the
    nearest definition first; choices: (source, name), the lists of allowed values."""
    r = rows.select(_clean("tableName").alias("tbl"), _clean("tableExtends").alias("parent"), _clean("columnName").alias("col"), _clean("columnType").alias("kind"), _clean("refTable").alias("ref"), "pos").filter("tbl <> ''")
    # The last row of a table names its parent; the last row of a column defines it.
    extends = r.filter("parent <> ''").groupBy("tbl").agg(F.max_by("parent", "pos").alias("parent"))
    own = r.filter("col <> ''").groupBy("tbl", "col").agg(F.min("pos").alias("pos"), F.max_by(F.struct("kind", "ref"), F.col("pos")).alias("m"))
    packed = own.select("tbl", "col", "pos", F.concat_ws("\u0001", "m.kind", "m.ref").alias("kind"))
    with_own = packed.select("tbl").distinct()
    full = inherit_columns(packed, extends).join(with_own, "tbl")
    kind = F.split("kind", "\u0001")
    full = full.withColumn("ref", kind[1]).withColumn("kind", kind[0]).withColumn("source", source_of(F.col("kind"), F.col("ref")))
    out = full.select("tbl", "col", "pos", "kind", "defined_in", (F.col("depth") == 0).alias("direct"), "source")
    if choices is None:
        return out.withColumn("n_allowed", F.lit(None).cast("long"))
    sizes = choices.filter("name IS NOT NULL").groupBy("source").agg(F.countDistinct("name").alias("n_allowed"))
    return out.join(sizes, "source", "left").select("tbl", "col", "pos", "kind", "defined_in", "direct", "source", "n_allowed")


def required_sources(reg: DataFrame) -> DataFrame:
    """M3: (source, pos) of the lists that the columns need, each at its first place."""
    return reg.filter("source IS NOT NULL").groupBy("source").agg(F.min(F.struct("tbl", "pos")).alias("m")).select("source", "m.tbl", "m.pos")


def table_types(reg: DataFrame) -> DataFrame:
    """(tbl, columns, kinds) in order: ancestors' columns first, each table's own behind them."""
    at = F.struct(F.col("direct"), F.col("pos"), F.col("col"), F.col("kind"))
    lists = reg.groupBy("tbl").agg(F.array_sort(F.collect_list(at)).alias("cs"))  # a table's columns: as many as the model has
    return lists.select("tbl", F.transform("cs", lambda c: c["col"]).alias("columns"), F.transform("cs", lambda c: c["kind"]).alias("kinds"))


def lookup_columns(wanted: DataFrame, reg: DataFrame, alias: tuple[str, str] = ("Resources", "Collections")) -> DataFrame:
    """(tbl, field, col, kind, defined_in) of each wanted (tbl, field), compared by letters and digits; a field that one
    of the two aliased tables lacks is taken from the other; null if there is none."""
    keyed = reg.select("tbl", norm_key(F.col("col")).alias("k"), F.struct("pos", "col", "kind", "defined_in").alias("m")).groupBy("tbl", "k").agg(F.min("m").alias("m"))
    other = F.when(F.col("tbl") == alias[0], alias[1]).when(F.col("tbl") == alias[1], alias[0])
    w = wanted.withColumn("k", norm_key(F.col("field"))).withColumn("other", other)
    near = keyed.select(F.col("tbl").alias("other"), "k", F.col("m").alias("m2"))
    both = w.join(keyed, ["tbl", "k"], "left").join(near, ["other", "k"], "left").withColumn("m", F.coalesce("m", "m2"))
    return both.select("tbl", "field", "m.col", "m.kind", "m.defined_in")


def typed_values(spark: SparkSession, values: Iterable[str] = (), lines: str | None = None, json_list: str | None = None) -> DataFrame:
    """(pos, value) of values given as list texts, as the lines of a file, and as a file with a JSON list; blanks dropped."""
    parts = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "o long, v string").select(F.lit(0).alias("src"), "o", F.posexplode(parse_list(F.col("v"))).alias("p", "value"))
    if lines:
        rows = spark.read.text(lines).select(F.monotonically_increasing_id().alias("o"), F.trim("value").alias("value")).filter("value <> ''")
        parts = parts.unionByName(rows.select(F.lit(1).alias("src"), "o", F.lit(0).alias("p"), "value"))
    if json_list:
        whole = spark.read.text(json_list, wholetext=True).select(F.from_json("value", "array<string>").alias("xs"))
        if not whole.filter("xs IS NULL").isEmpty():
            raise ValueError("the file holds no JSON list")
        parts = parts.unionByName(whole.select(F.lit(2).alias("src"), F.lit(0).cast("long").alias("o"), F.posexplode("xs").alias("p", "value")).filter("trim(value) <> ''"))
    return parts.select(F.struct("src", "o", "p").alias("pos"), "value")


def example_overrides(wanted: DataFrame, examples: DataFrame) -> DataFrame:
    """(tbl, col, good, bad) of each wanted (tbl, col): the example under its table, else under the aliased one."""
    key = lambda t, c: F.concat_ws(".", norm_key(t), norm_key(c))
    e = examples.select(key(F.col("tbl"), F.col("col")).alias("k"), "good", "bad").dropDuplicates(["k"])
    other = F.when(F.col("tbl") == "Resources", "Collections").when(F.col("tbl") == "Collections", "Resources").otherwise(F.col("tbl"))
    w = wanted.withColumn("k1", key(F.col("tbl"), F.col("col"))).withColumn("k2", key(other, F.col("col")))
    one, two = (e.select(F.col("k").alias(k), F.struct("good", "bad").alias(v)) for k, v in (("k1", "e1"), ("k2", "e2")))
    return w.join(one, "k1", "left").join(two, "k2", "left").withColumn("e", F.coalesce("e1", "e2")).select("tbl", "col", "e.good", "e.bad")


def first_existing(spark: SparkSession, candidates: Iterable[str]) -> str | None:
    """The first candidate path that exists, in any file system that Spark reads; null if none does."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for c in dict.fromkeys(x for x in candidates if x):
        path = jvm.org.apache.hadoop.fs.Path(c)
        if path.getFileSystem(conf).exists(path):
            return c
    return None


def env_int(name: str, default: int, least: int | None = None) -> int:
    """Whole number of a setting; the default if it is missing or none; never below ``least``."""
    try:
        value = int(os.environ.get(name, "").strip())
    except ValueError:
        value = default
    return value if least is None else max(least, value)
