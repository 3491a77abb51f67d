"""Mixing sources to target weights with capped repetition (problem 9).

Method: tokens are counted per document with a public tokenizer and aggregated per source; repetition rates follow from
the target shares; every document is emitted floor(rate) times plus one hash-seeded Bernoulli copy with probability equal
to the fraction. Only one row per source reaches the driver.

The mix is as large as all documents together if every share can be held at that size, else as large as the shortest
source allows (``shrink=True``); with ``shrink=False`` the size is kept, short sources are used max_repeats times and the
report shows the shares reached.

Defined results: null and empty texts have 0 tokens; documents without a source, or of a source without a target, count
for the size of all documents but are not mixed; a target without documents is short and gets share 0 (the others keep
their proportions); repeated targets of a source count once, with the greatest share and the least max_repeats; null
share or cap counts as 0; an empty document table gives an empty mix. Copies are numbered from 1.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from math import isfinite

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded in slices cut where no token can cross, to bound memory; a text without such a place is encoded whole.
SLICE = 1_000_000
_BETWEEN = re.compile(r"[A-Za-z](?= [A-Za-z])")


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = TOKENIZER) -> int:
    if not isinstance(text, str) or not text:
        return 0
    enc = encoder(path)
    total = at = 0
    while at < len(text):
        # A space between letters always parts two pieces of the split pattern, so slices count as the whole text does.
        edge = _BETWEEN.search(text, at + SLICE)
        end = edge.start() + 1 if edge else len(text)
        total += len(enc.encode_ordinary(text[at:end]))
        at = end
    return total


def with_tokens(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"].astype(object), "tokens": [count_tokens(t, path) for t in b["text"]]})

    return docs.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, tokens long")


def plan(tokens: DataFrame, targets: DataFrame, shrink: bool = True) -> list[dict]:
    """One dict per target source: n_docs, tokens, target_share, max_repeats, short, rate."""
    goals = targets.filter("source IS NOT NULL").groupBy("source").agg(
        F.max(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats")
    )
    per = tokens.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").alias("tokens"))
    per = cut(per)  # one row per source
    total = per.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    rows = [r.asDict() for r in goals.join(per, "source", "left").orderBy("source").collect()]
    size = float(total)
    for r in rows:
        r["n_docs"], r["tokens"] = r["n_docs"] or 0, r["tokens"] or 0
        r["short"] = r["tokens"] * r["max_repeats"] < r["target_share"] * total
        if shrink and r["target_share"] > 0 and r["tokens"] * r["max_repeats"] > 0:
            size = min(size, r["tokens"] * r["max_repeats"] / r["target_share"])
    for r in rows:
        rate = r["target_share"] * size / r["tokens"] if r["tokens"] else 0.0
        r["rate"] = min(rate, float(r["max_repeats"])) if isfinite(rate) else 0.0
        r["total"] = total
    return rows


_PLAN = "source string, target_share double, max_repeats long, n_docs long, tokens long, short boolean, rate double, total long"


def _plan_frame(tokens: DataFrame, rows: list[dict]) -> DataFrame:
    names = [c.split()[0] for c in _PLAN.split(", ")]
    return tokens.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], _PLAN)


def mix(tokens: DataFrame, rows: list[dict], seed: int = 17) -> DataFrame:
    """(doc_id, source, tokens, copy_no): the documents of the mix, no shuffle of documents."""
    # One row per target source; the driver holds them anyway.
    rates = _plan_frame(tokens, rows).select("source", "rate", F.col("max_repeats").alias("cap"))
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**53)) / F.lit(float(2**53))).alias("u")
    with_rate = tokens.join(F.broadcast(rates), "source").withColumn("u", u)
    n = F.floor("rate") + F.when(F.col("u") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return (
        with_rate.withColumn("n", F.least(n, F.col("cap")).cast("int")).filter("n > 0")
        .select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no"))
    )


def report(tokens: DataFrame, rows: list[dict], seed: int = 17) -> DataFrame:
    """Per target source: what it has, its rate, and the copies, tokens and share reached in the mix."""
    done = mix(tokens, rows, seed).groupBy("source").agg(F.count(F.lit(1)).alias("copies"), F.sum("tokens").alias("mix_tokens"))
    out = _plan_frame(tokens, rows).drop("total").join(done, "source", "left").fillna(0, ["copies", "mix_tokens"])
    whole = done.agg(F.sum("mix_tokens").alias("whole"))  # one row
    return out.join(F.broadcast(whole)).withColumn(
        "reached_share", F.coalesce(F.col("mix_tokens") / F.col("whole"), F.lit(0.0))
    ).drop("whole")


def short_sources(docs: DataFrame, targets: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(source): targets that stay too small for a mix as large as all documents."""
    tokens = with_tokens(docs, path)
    rows = plan(tokens, targets)
    return _plan_frame(tokens, rows).filter("short").select("source")
