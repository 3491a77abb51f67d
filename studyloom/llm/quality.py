"""Per-document text quality statistics and the prose / list / table / junk shape (problem 10).

Method: every statistic of ``textstats`` is computed in one pass; the mean and covariance of prose are fitted robustly per
language over all documents (median and MAD pick the start set, concentration steps refine it, all as distributed
aggregates of which only one row per language reaches the driver); the squared Mahalanobis distance of a document splits
into one contribution per statistic. A document beyond the cut is not like prose of its language; which shape it has is
read off the statistics by fixed bounds, as the distance alone does not tell one kind of junk from a list. Statistics also tell odd layouts of prose (verse, one sentence per line without full stops) from
lists, since layout alone must not make prose a case.

Defined results: null, empty and blank texts have zero statistics, no distance and no shape; a text with few common
words takes the language it declares, else the pooled model; repeated documents give repeated rows; an empty table gives an empty table. Only doc_id,
text and lang are read, so clashing names cannot matter. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.llm.textstats import LANGS, STATS, text_stats
from studyloom.session import cut

P = len(STATS)
PRIOR_DOCS = 30  # documents that the pooled model counts as in that of a language
START = 35.2  # start set: sum of squares of robust standard deviations from the median
CUT = 34.5  # 0.999 quantile of chi-square with 13 degrees of freedom
#: Least standard deviation of a statistic, so that one that is constant in prose cannot make the covariance singular.
FLOOR = np.array([0.3, 0.2, 0.01, 0.02, 0.15, 0.03, 0.3, 0.25, 0.08, 0.1, 0.15, 0.03, 0.015])
POOLED = "*"


def with_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, STATS): lang is the language found in the text, else the declared one in lower case."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [text_stats(t if isinstance(t, str) else None) for t in b["text"]]
            out = pd.DataFrame(rows, columns=["lang", *STATS]) if rows else pd.DataFrame(columns=["lang", *STATS])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            declared = b["lang"].astype("string").str.strip().str.lower().to_numpy(dtype=object)
            found = [r[0] or (d if isinstance(d, str) and d in LANGS else None) for r, d in zip(rows, declared)]
            out["lang"] = pd.Series(found, dtype=object, index=out.index)
            yield out

    schema = "doc_id long, lang string, " + ", ".join(f"{s} double" for s in STATS)
    return docs.select("doc_id", "text", "lang").mapInPandas(run, schema)


def fit_prose(stats: DataFrame, steps: int = 2) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{language: (mean, inverse covariance)} of prose, and of all languages together under "*".

    Every step is one aggregate over all documents, of which one row per language reaches the driver; the pooled model is the
    sum of the languages'. A language's model is drawn to the pooled one by ``PRIOR_DOCS`` documents, at every size alike.
    """
    rows = stats.filter(F.col("log_words") > 0).withColumn("grp", F.coalesce("lang", F.lit(POOLED)))

    def middle(cols: list) -> dict[str, np.ndarray]:
        got = rows_at.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, 0.5, 1000).alias(s) for c, s in zip(cols, STATS)]).collect()
        own = {r["grp"]: (r["n"], np.array([r[s] for s in STATS], float)) for r in got}
        spoken = {g: v for g, v in own.items() if g != POOLED} or own
        total = sum(n for n, _ in spoken.values())
        pooled = sum(n * v for n, v in spoken.values()) / total if total else None
        # Documents that tell no language are judged by the pooled model.
        return {**{g: v for g, (_, v) in spoken.items()}, POOLED: pooled} if total else {}

    rows_at = rows
    centre = middle([F.col(s) for s in STATS])
    if not centre:
        return {}
    middles = stats.sparkSession.createDataFrame([(g, *map(float, c)) for g, c in centre.items()], ["grp", *[f"m_{s}" for s in STATS]])  # one row a language
    rows_at = rows.join(F.broadcast(middles), "grp")
    spread = {g: np.maximum(1.4826 * v, FLOOR) for g, v in middle([F.abs(F.col(s) - F.col(f"m_{s}")) for s in STATS]).items()}

    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    model = {g: (centre[g], np.diag(1 / spread[g] ** 2)) for g in centre}
    base = centre[POOLED]
    for step in range(steps + 1):
        state, limit = model, START if step == 0 else CUT

        @F.pandas_udf("boolean")
        def inside(grp: pd.Series, *cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in cols])
            ok = np.zeros(len(x), bool)
            for g in grp.unique():
                mean, inv = state.get(g, state[POOLED])
                own = (grp == g).to_numpy()
                z = x[own] - mean
                ok[own] = np.einsum("ij,jk,ik->i", z, inv, z) <= limit
            return pd.Series(ok)

        agg = [F.count(F.lit(1)).alias("n")]
        agg += [F.sum(F.col(s) - float(base[i])).alias(f"s{i}") for i, s in enumerate(STATS)]
        agg += [F.sum((F.col(STATS[i]) - float(base[i])) * (F.col(STATS[j]) - float(base[j]))).alias(f"p{i}_{j}") for i, j in pairs]
        sums: dict[str, tuple[float, np.ndarray, np.ndarray]] = {}
        for r in rows.filter(inside("grp", *STATS)).groupBy("grp").agg(*agg).collect():
            products = np.zeros((P, P))
            for i, j in pairs:
                products[i, j] = products[j, i] = r[f"p{i}_{j}"]
            sums[r["grp"]] = (r["n"], np.array([r[f"s{i}"] for i in range(P)]), products)
        if not sums:
            return state
        n, s, q = (sum(v[k] for v in sums.values()) for k in range(3))
        mean, cov = s / n, q / n - np.outer(s / n, s / n)
        model = {}
        for g in {*sums, POOLED}:
            m, c = mean, cov
            if g != POOLED:
                k, t, u = sums[g]
                w = k / (k + PRIOR_DOCS)
                m, c = w * t / k + (1 - w) * mean, w * (u / k - np.outer(t / k, t / k)) + (1 - w) * cov
            c = c + np.diag(np.maximum(FLOOR**2 - np.diag(c), 0) + 1e-9)
            model[g] = (m + base, np.linalg.inv(c))
    return model


def shape_of(x: dict[str, float]) -> str:
    """prose, list, table or junk of a document that lies beyond the cut."""
    common, unit = x["common_share"], x["log_unit_words"]
    if x["repetition"] > 0.9 or (x["repetition"] > 0.75 and x["cell_share"] < 0.5):
        return "junk"
    if x["cell_share"] >= 0.5 and x["symbol_ratio"] < 0.6:
        return "table"
    if x["symbol_ratio"] > 0.3 or x["single_share"] > 0.4 or x["vowel_share"] < 0.27 or x["vowel_share"] > 0.62:
        return "junk"
    if common < 0.2 and unit > 3.9:
        return "junk"
    if common < 0.2 or (unit < 2.65 and x["log_sentence_words"] > 3.6):
        return "list"
    return "prose"


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, STATS, distance, contributions, shape): contributions sum to the squared distance."""
    stats = cut(with_stats(docs))
    model = fit_prose(stats)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = b[list(STATS)].to_numpy(float)
            part = np.full(x.shape, np.nan)
            lang = b["lang"].astype(object).where(b["lang"].notna(), POOLED)
            for g in lang.unique():
                mean, inv = model.get(g, model.get(POOLED, (np.zeros(P), np.eye(P))))
                own = (lang == g).to_numpy()
                z = x[own] - mean
                part[own] = z * (z @ inv)
            d2 = part.sum(axis=1)
            empty = x[:, 0] <= 0
            blank = empty & ~(x[:, 2:4].sum(axis=1) > 0)
            far = (d2 > CUT) & ~blank
            shapes = np.full(len(b), "prose", dtype=object)
            for i in np.nonzero(far)[0]:
                shapes[i] = shape_of(dict(zip(STATS, x[i])))
            shapes[blank] = None
            out = b.copy()
            out["distance"] = np.where(blank, np.nan, np.sqrt(np.maximum(d2, 0)))
            out["contributions"] = [None if e else p for e, p in zip(blank, part)]
            out["shape"] = pd.Series(shapes, dtype=object, index=out.index)
            yield out

    schema = ", ".join(f"{n} {t}" for n, t in stats.dtypes) + ", distance double, contributions array<double>, shape string"
    return stats.mapInPandas(run, schema)


def not_prose(docs: DataFrame) -> DataFrame:
    """(doc_id, shape) of the documents that are lists, tables or junk."""
    return quality(docs).filter("shape IN ('list', 'table', 'junk')").select("doc_id", "shape").distinct()
