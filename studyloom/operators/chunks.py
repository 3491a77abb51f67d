"""Overlapping chunks of a text as a table function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_bounds(text: str, size: int, overlap: int, most: int | None = None) -> list[str]:
    """Chunks of at most size characters, cut at the last line end or space past 60 % of the size, with an overlap.

    size is at least 2000, overlap at most half of it. Chunks are stripped, blank ones dropped; a text without any chunk
    is its own only chunk. No chunk begins where the one before began.
    """
    size = max(2000, size)
    overlap = min(max(0, overlap), size // 2)
    out: list[str] = []
    at, n = 0, len(text)
    while at < n and (most is None or len(out) < most):
        end = min(n, at + size)
        if end < n:
            edge = max(text.rfind(mark, at + int(0.6 * size), end) for mark in "\n ")
            if edge > at + 1000:
                end = edge
        if piece := text[at:end].strip():
            out.append(piece)
        if end >= n:
            break
        back = max(0, end - overlap)
        at = back if back > at else end
    return out or [text]


@F.udtf(returnType="idx int, chunk string")
class ChunkText:
    """LATERAL chunk_text(text, size, overlap): one row per chunk, idx from 1."""

    def eval(self, text: str, size: int, overlap: int):
        if text is not None:
            for i, piece in enumerate(chunk_bounds(text, size, overlap), 1):
                yield i, piece


def chunk_table(df: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, idx, chunk) for every chunk of every text; null texts give no chunk."""
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return texts.lateralJoin(ChunkText(F.col("t").outer(), F.lit(size), F.lit(overlap))).select(F.col("k").alias(key), "idx", "chunk")
