"""Sinks (K1-K3, K8, U6): one folder per table; files are written by the executors."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """K1, K2: every table under its name, as Parquet, CSV or JSON lines (no workbook writer is installed)."""
    for name, df in tables.items():
        w = df.write.mode("overwrite").format(fmt)
        (w.option("header", "true") if fmt == "csv" else w).save(f"{folder}/{name}")


def union_rows(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts under the union of their columns, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def append_events(events: DataFrame, folder: str) -> None:
    """K8: status events appended as JSON lines."""
    events.write.mode("append").json(folder)


def sections_text(sections: dict[str, dict]) -> str:
    """K3: sorted TOML sections; booleans and numbers literal, everything else as a JSON string."""
    out = []
    for name in sorted(sections):
        out.append(f"[{name}]")
        for k, v in sections[name].items():
            literal = json.dumps(v) if isinstance(v, (bool, int, float)) else json.dumps(v if isinstance(v, str) else json.dumps(v), ensure_ascii=False)
            out.append(f"{k} = {literal}")
        out.append("")
    return "\n".join(out)
