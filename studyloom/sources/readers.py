"""Sources (S3-S6, S10, S16, K9): every reader has an explicit schema; nothing is inferred from data."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.functions.text import safe_stem


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every value a text, missing ones blank."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', quote='"')
    return df.fillna("")


def model_rows(spark: SparkSession, folder: str, profile: str) -> DataFrame:
    """Rows of all CSV files of a folder whose ``profiles`` list names the profile."""
    rows = csv_rows(spark, f"{folder}/*.csv").withColumn("file", F.col("_metadata.file_name"))
    names = F.filter(F.transform(F.split("profiles", ","), lambda x: F.trim(x)), lambda x: x != "")
    return rows.filter(F.array_contains(names, profile))


def choice_values(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank names of a list."""
    return csv_rows(spark, path).select(F.trim("name").alias("name")).filter("name <> ''").distinct()


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """S3: (stem, text) of text files, blank ones as empty text."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("p"), "value")
    return files.select(safe_stem(F.col("p")).alias("stem"), F.when(F.trim("value") == "", "").otherwise(F.col("value")).alias("text"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """K9: (path, sha256) of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def sections(path: str) -> dict[str, dict]:
    """The ``task_*`` sections of a TOML file (driver side, a few kB)."""
    with Path(path).open("rb") as f:
        data = tomllib.load(f)
    return {k: v for k, v in sorted(data.items()) if k.startswith("task_") and isinstance(v, dict)}


def missing_files(spark: SparkSession, wanted: list[str], present: DataFrame) -> DataFrame:
    """Wanted paths that are not there."""
    return spark.createDataFrame([(w,) for w in wanted], "path string").join(present.select("path").distinct(), "path", "left_anti")
