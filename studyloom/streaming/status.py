"""Status events as a stream: file source, watermark on event time, counts per state and window (K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "timestamp_utc string, run_id string, state string, message string, output_file string"


def status_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a folder of JSON lines, with ``at`` as event time; events without a readable time are left out."""
    raw = spark.readStream.schema(SCHEMA).json(folder)
    return raw.withColumn("at", F.try_to_timestamp("timestamp_utc")).filter("at IS NOT NULL")


def state_counts(events: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Events per window, run and state; events later than the watermark are dropped by the engine."""
    w = F.window("at", window)
    return events.withWatermark("at", late).groupBy(w.alias("w"), "run_id", "state").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("start"), "run_id", "state", "n"
    )


def latest_states(events: DataFrame) -> DataFrame:
    """Last state of each run (complete mode; one row per run is the state kept)."""
    return events.groupBy("run_id").agg(F.max_by("state", "at").alias("state"), F.max("at").alias("at"))
