"""Text of PDF files, if a parser is installed."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

try:
    import pypdf
except ImportError:
    pypdf = None


def pdf_texts(spark: SparkSession, path: str, max_pages: int = 0) -> DataFrame:
    """(path, text, n_pages): non-blank page texts joined by a blank line; unreadable files have an empty text."""
    if pypdf is None:
        raise RuntimeError("no PDF parser is installed")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, data in zip(b["path"], b["content"]):
                pages: list[str] = []
                n = 0
                try:
                    reader = pypdf.PdfReader(io.BytesIO(data))
                    n = len(reader.pages)
                    for page in list(reader.pages)[: max_pages or None]:
                        try:
                            pages.append(page.extract_text() or "")
                        except Exception:  # noqa: BLE001 - an unreadable page is passed over
                            continue
                except Exception:  # noqa: BLE001 - an unreadable file has no text
                    pages = []
                yield pd.DataFrame({"path": [p], "text": pd.Series(["\n\n".join(x for x in pages if x.strip())], dtype=object), "n_pages": [n]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, text string, n_pages long")
