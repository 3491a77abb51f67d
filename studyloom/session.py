"""Session helpers shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's own; in local mode (tests), where none is set, a fresh local one."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="studyloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage through the shared folder, so lost executors cost no recomputation of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Partitions to aim at for CPU-bound Python stages: at least the cluster's slots, at least the shuffle setting."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Redistribute by keys (round robin without) so that a CPU-heavy Python stage uses every core."""
    n = parallelism(df.sparkSession) * 2
    return df.repartition(n, *keys) if keys else df.repartition(n)


def blank(col):
    """True for null, empty and whitespace-only strings."""
    return col.isNull() | ~col.rlike(r"[^\s\p{Z}]")


def strip(col):
    """Trim all Unicode white space at both ends."""
    return F.regexp_replace(col, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def key_norm(col):
    """Reference keys compare without case, trimmed, runs of white space as one."""
    return F.lower(strip(F.regexp_replace(col, r"[\s\p{Z}]+", " ")))


