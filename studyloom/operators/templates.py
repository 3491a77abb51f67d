"""Templates, instruction texts and their differences as tables."""

from __future__ import annotations

import difflib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from studyloom.operators.relational import keyed_diff

FEW = 16  # a list of at most so many values is written out


def ordered_keys(template: str | None) -> list[str]:
    """Keys of a JSON object in order; [] for anything else."""
    try:
        obj = json.loads(template) if template else None
    except ValueError:
        return []
    return list(obj) if isinstance(obj, dict) else []


def leaves(template, prefix: str = "") -> list[tuple[str, str]]:
    """(path, kind) of the leaves; lists as "a[]", objects in lists as "a[].b"."""
    if isinstance(template, dict):
        return [x for k, v in template.items() for x in leaves(v, f"{prefix}.{k}" if prefix else k)]
    if isinstance(template, list):
        inner = template[0] if template else "string"
        return leaves(inner, f"{prefix}[]") if isinstance(inner, dict) else [(f"{prefix}[]", str(inner))]
    return [(prefix, str(template))]


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(task, path, kind, pos) of all leaves of all templates (a few hundred rows, made by the driver)."""
    rows = [(t, p, k, i) for t, j in sorted(templates.items()) for i, (p, k) in enumerate(leaves(json.loads(j) if ordered_keys(j) else {}))]
    return spark.createDataFrame(rows, "task string, path string, kind string, pos int")


def template_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(task, path, action)."""
    key = F.concat_ws("\u0001", "task", "path").alias("key")
    d = keyed_diff(old.select(key, "kind"), new.select(key, "kind"), "key", "kind")
    return d.select(F.split("key", "\u0001")[0].alias("task"), F.split("key", "\u0001")[1].alias("path"), "action")


def constraint_lines(fields: DataFrame, choices: DataFrame) -> DataFrame:
    """M4: (path, line): the values of a field's list if they are few, else how many there are. fields: (path, src); choices: (src, name)."""
    sets = choices.filter("name IS NOT NULL").groupBy("src").agg(
        F.countDistinct("name").alias("n"), F.slice(F.array_sort(F.collect_set("name")), 1, FEW).alias("vs")
    )
    few = F.concat(F.col("path"), F.lit(": one of "), F.array_join("vs", ", "))
    many = F.concat(F.col("path"), F.lit(": one of "), F.col("n").cast("string"), F.lit(" values of "), F.col("src"))
    return fields.join(sets, "src").select("path", F.when(F.col("n") <= FEW, few).otherwise(many).alias("line"))


def blocks(df: DataFrame, key: str, text: str, header: str = r"^[A-Za-z_]+:\s*$") -> DataFrame:
    """(key, block, head, body): lines from one header line to the next; lines before the first header are block 0."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).withColumn("h", F.col("line").rlike(header).cast("int"))
    b = lines.withColumn("block", F.sum("h").over(Window.partitionBy(key).orderBy("pos")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("h") == 0, F.struct("pos", "line")))), lambda s: s["line"]), "\n")
    return b.groupBy(key, "block").agg(F.max(F.when(F.col("h") == 1, F.rtrim(F.regexp_replace("line", ":", "")))).alias("head"), body.alias("body"))


@F.pandas_udf(StringType())
def text_diff(old: pd.Series, new: pd.Series) -> pd.Series:
    """Unified difference of two texts; "" if they are equal."""
    def one(a, b):
        return "\n".join(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), "old", "new", lineterm=""))

    return pd.Series([one(a, b) for a, b in zip(old, new)], dtype=object)


def capped_lines(c: Column, most: int) -> Column:
    """K6, K7: at most so many lines, with a mark where more were."""
    ls = F.split(c, "\n")
    return F.when(F.size(ls) > most, F.concat(F.array_join(F.slice(ls, 1, most), "\n"), F.lit("\n...[truncated]..."))).otherwise(c)
