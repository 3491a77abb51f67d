"""Fuzzy matching of distinct values against a list with the sequence-matcher ratio."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.session import cut, parallelism

BLOCK = 20_000  # choices that meet a part of the values at once


def _best(raw: str, keyed: list[tuple[str, str]], top: int) -> list[tuple[float, str, str]]:
    """(-ratio, canonical, key) of the top choices; upper bounds of the ratio spare most exact ratios."""
    out: list[tuple[float, str, str]] = []
    for c, k in keyed:
        floor = -out[-1][0] if len(out) >= top else -1.0
        if 2.0 * min(len(raw), len(k)) < floor * (len(raw) + len(k)):
            continue
        m = SequenceMatcher(None, raw, k)  # the value first: the ratio is not symmetric
        if m.quick_ratio() >= floor:
            out = sorted([*out, (-m.ratio(), c, k)])[:top]
    return out


def fuzzy_match(values: DataFrame, col: str, choices: DataFrame, cutoff: float = 0.96, margin: float = 0.02, top: int = 5) -> DataFrame:
    """(col, canonical, score, suggestions): best choice if it scores at least cutoff and leads by the margin.

    choices: (key, canonical), one row a key; the list may have any length: blocks of it meet the distinct values, and the best of
    all blocks are put together. Equal scores go to the lesser canonical value. Null values give no row; an empty list leaves all
    values without a choice; suggestions are the distinct canonical values of the top choices.
    """
    top = max(top, 2)
    vals = values.select(F.col(col).alias("raw")).filter("raw IS NOT NULL").distinct()
    keyed = cut(choices.filter("key IS NOT NULL").select("key", "canonical"))
    blocks = max(1, -(-keyed.count() // BLOCK))
    salts = parallelism(values.sparkSession)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vals.withColumn("block", spread(blocks)).withColumn("salt", F.pmod(F.xxhash64("raw"), F.lit(salts)).cast("int"))
    right = keyed.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("salt", spread(salts))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        listed = sorted(zip(b["canonical"], b["key"]))
        rows = [(raw, *hit) for raw in a["raw"] for hit in _best(raw, listed, top)]
        return pd.DataFrame(rows, columns=["raw", "minus", "canonical", "key"])

    by = lambda df: df.repartition(salts, "block", "salt").groupBy("block", "salt")  # noqa: E731 - few rows, but long work
    hits = by(left).cogroup(by(right)).applyInPandas(meet, "raw string, minus double, canonical string, key string")
    # At most top rows a value and block.
    best = hits.groupBy("raw").agg(F.slice(F.array_sort(F.collect_list(F.struct("minus", "canonical", "key"))), 1, top).alias("hits"))
    score = lambda i: F.coalesce(-F.try_element_at("hits", F.lit(i))["minus"], F.lit(0.0))
    sure = (score(1) >= cutoff) & (score(1) - score(2) >= margin)
    none = F.array().cast("array<string>")
    return vals.join(best, "raw", "left").select(
        F.col("raw").alias(col), F.when(sure, F.try_element_at("hits", F.lit(1))["canonical"]).alias("canonical"), F.round(score(1), 6).alias("score"),
        F.coalesce(F.array_distinct(F.transform("hits", lambda h: h["canonical"])), none).alias("suggestions"),
    )
