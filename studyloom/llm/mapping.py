"""Mapping free-entered values to a reference list (problem 5).

Method: a prefix-filter set-similarity join. Typed values (distinct ones only, so repeats cost nothing) and the names,
labels, codes and acronyms of the list are brought to comparable forms; a form is the set of padded letter pairs of its
words, ordered by global rarity; only the rare prefixes are joined, positional filters drop pairs that cannot share the
pairs that the allowed edits leave whole, so no acceptable pair is lost; Jaccard is counted exactly, candidates whose words
do not pair off with the typed ones within the edits their lengths allow are left out, and the entry with the best Jaccard is
kept. Values without an entry, and values whose best entries are several, are reported as UNMATCHED.

Defined results: null and blank values give no row; repeated list rows count once; entries without code are never
matched; an empty list leaves every value UNMATCHED; long values are compared whole. A value that fills much of the table
is joined back by broadcast: there are at most ``HOT_SHARE`` such values.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from studyloom.llm.placenames import allowed, edits, forms, grams, letters, words_of
from studyloom.operators.multivalue import explode_values
from studyloom.operators.skew import join_hot
from studyloom.session import blank, cut


def value_forms(values: DataFrame) -> DataFrame:
    """(field, val) to (field, val, kind, reading, form, grams): kind "n" for names, "c" for codes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for f, v in zip(b["field"], b["val"]):
                read = forms(v)
                for k, x in enumerate(read):
                    rows.append((f, v, "n", k + 1, x, grams(x)))
                    code = letters(x)
                    if " " not in x or k == 0:
                        code = letters(v) if k == 0 else code
                        if len(code) > 1:
                            rows.append((f, v, "c", k, code, grams(code)))
            yield pd.DataFrame(rows, columns=["field", "val", "kind", "reading", "form", "grams"], dtype=object)

    return values.mapInPandas(run, "field string, val string, kind string, reading int, form string, grams array<string>")


def list_forms(entries: DataFrame) -> DataFrame:
    """(field, name, label, acronym, code) to (field, code, kind, form, grams)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = set()
            for f, n, lab, a, c in zip(b["field"], b["name"], b["label"], b["acronym"], b["code"]):
                for x in (n, lab):
                    if isinstance(x, str) and (w := " ".join(sorted(words_of(x)))):
                        rows.add((f, c, "n", w))
                for x in (c, a):
                    if isinstance(x, str) and (w := letters(x)):
                        rows.add((f, c, "c", w))
            yield pd.DataFrame([(*r, grams(r[3])) for r in sorted(rows)], columns=["field", "code", "kind", "form", "grams"], dtype=object)

    return entries.filter("code IS NOT NULL").distinct().mapInPandas(run, "field string, code string, kind string, form string, grams array<string>")


def _ordered(forms_: DataFrame, rarity: DataFrame, keys: list[str]) -> DataFrame:
    """Grams of each form ordered by rarity (then by gram), as ``toks``."""
    long = forms_.select(*keys, F.explode("grams").alias("g")).join(rarity, ["field", "kind", "g"])
    return long.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "g"))), lambda s: s["g"]).alias("toks"))


@F.pandas_udf(IntegerType())
def _spoiled(kind: pd.Series, form: pd.Series) -> pd.Series:
    """Grams of a form that allowed edits (three each, a swap's) or moved spaces (two each) change at most; codes must be equal."""
    return pd.Series([0 if k == "c" else max(3 * sum(map(allowed, x.split())), 2 * x.count(" ")) for k, x in zip(kind, form)], dtype="int32")


def similar_forms(left: DataFrame, right: DataFrame, t: float | None = None) -> DataFrame:
    """All pairs (field, kind, form, other, jaccard) of forms of left and right with Jaccard of at least t; without t, those
    that share as many grams as any pair that edits() accepts."""
    keys = ["field", "kind", "form"]
    a = left.select(*keys, "grams").dropDuplicates(keys)
    b = right.select(*keys, "grams").dropDuplicates(keys)
    rarity = a.unionAll(b).select("field", "kind", F.explode("grams").alias("g")).groupBy("field", "kind", "g").agg(F.count(F.lit(1)).alias("n"))

    def prefixed(df: DataFrame, name: str) -> DataFrame:
        o = _ordered(df, rarity, keys).withColumn("len", F.size("toks"))
        own = F.greatest(F.lit(1), F.col("len") - _spoiled("kind", "form")) if t is None else F.expr(f"cast(ceil({t} * len - 1e-9) as int)")
        p = o.withColumn("own", own).withColumn("pre", F.expr("slice(toks, 1, len - own + 1)"))
        return p.select("field", "kind", F.col("form").alias(name), F.col("toks").alias(f"{name}_toks"), F.col("len").alias(f"{name}_len"), F.col("own").alias(f"{name}_own"),
                        F.posexplode("pre").alias(f"{name}_pos", "g"))

    x, y = prefixed(a, "form"), prefixed(b, "other")
    if t is None:
        need, fits = F.greatest("form_own", "other_own"), F.least("form_len", "other_len") >= F.greatest("form_own", "other_own")
    else:
        need = F.ceil(F.lit(t / (1 + t)) * (F.col("form_len") + F.col("other_len")) - 1e-9)  # the slack is for rounding of floats
        fits = (F.col("other_len") >= t * F.col("form_len") - 1e-9) & (F.col("form_len") >= t * F.col("other_len") - 1e-9)
    left_over = F.least(F.col("form_len") - F.col("form_pos"), F.col("other_len") - F.col("other_pos"))
    pairs = (
        x.join(y, ["field", "kind", "g"])
        .filter(fits)
        # Positional filter at the first shared prefix token of the pair: what is left must still reach the overlap.
        .groupBy("field", "kind", "form", "other").agg(
            F.max(left_over).alias("left_over"), F.first("form_toks").alias("p"), F.first("other_toks").alias("q"), F.first(need).alias("need")
        )
        .filter(F.col("left_over") >= F.col("need"))
    )
    common = F.size(F.array_intersect("p", "q"))
    jaccard = common / (F.size("p") + F.size("q") - common)
    found = pairs.filter(common >= F.col("need")) if t is None else pairs.filter(jaccard >= t - 1e-9)
    return found.select("field", "kind", "form", "other", jaccard.alias("jaccard"))


@F.pandas_udf(IntegerType())
def _edits(kind: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([(0 if x == y else -1) if k == "c" else edits(x, y) for k, x, y in zip(kind, a, b)], dtype="int32")


def map_values(values: DataFrame, entries: DataFrame) -> DataFrame:
    """(field, val, code, edits, jaccard) of each distinct (field, val); code is null if unmatched."""
    known = values.select("field", "val").distinct()
    typed, listed = cut(value_forms(known)), cut(list_forms(entries))
    close = similar_forms(typed, listed).withColumn("edits", _edits("kind", "form", "other")).filter("edits >= 0")
    hits = (
        typed.select("field", "val", "kind", "reading", "form").join(close, ["field", "kind", "form"])
        .join(listed.select("field", "kind", F.col("form").alias("other"), "code"), ["field", "kind", "other"])
    )
    rank = F.struct(F.col("reading"), (F.col("kind") != "c").alias("k"), (-F.col("jaccard")).alias("j"), F.col("edits"))
    best = hits.withColumn("rank", rank).withColumn("top", F.min("rank").over(Window.partitionBy("field", "val"))).filter("rank = top")
    one = best.groupBy("field", "val").agg(
        F.min("code").alias("code"), F.countDistinct("code").alias("n"), F.min("edits").alias("edits"), F.max("jaccard").alias("jaccard")
    ).filter("n = 1").drop("n")
    return known.join(one, ["field", "val"], "left")


def typed_places(resources: DataFrame, matches: DataFrame) -> DataFrame:
    """(tbl, row_id, field, pos, val, lst) of all typed countries and regions; lst names the list."""
    packed = explode_values(resources, "resources", "row_id", "countries").unionAll(explode_values(resources, "resources", "row_id", "regions"))
    single = matches.filter(~blank(F.col("raw")) & F.col("field").isin("countries", "regions")).select(
        F.lit("choice_matches").alias("tbl"), F.col("match_id").alias("row_id"), F.lit("raw").alias("field"), F.lit(1).cast("long").alias("pos"),
        F.col("raw").alias("val"), F.col("field").alias("lst"),
    )
    return packed.withColumn("lst", F.col("field")).unionAll(single.select(*packed.columns, "lst"))


def place_list(countries: DataFrame, regions: DataFrame) -> DataFrame:
    cols = ("name", "label", "acronym", "code")
    return countries.select(F.lit("countries").alias("field"), *cols).unionAll(regions.select(F.lit("regions").alias("field"), *cols))


def mapped_places(resources: DataFrame, matches: DataFrame, countries: DataFrame, regions: DataFrame) -> DataFrame:
    """(lst, val, tbl, row_id, field, pos, code, edits, jaccard) of every typed value."""
    rows = typed_places(resources, matches)
    counts = cut(rows.groupBy("lst", "val").agg(F.count(F.lit(1)).alias("n")))
    mapped = cut(map_values(counts.select(F.col("lst").alias("field"), "val"), place_list(countries, regions)))
    return join_hot(rows, mapped.withColumnRenamed("field", "lst"), ["lst", "val"], counts)


def corrected_matches(resources: DataFrame, matches: DataFrame, countries: DataFrame, regions: DataFrame) -> DataFrame:
    """choice_matches with the entry found: (match_id, field, raw, mapped, code, corrected, verdict)."""
    found = mapped_places(resources, matches, countries, regions).filter("tbl = 'choice_matches'").select(F.col("row_id").alias("match_id"), "code").distinct()
    names = place_list(countries, regions).groupBy("field", "code").agg(F.min("name").alias("corrected"))
    out = matches.select("match_id", "field", "raw", "mapped").join(found, "match_id", "left").join(names, ["field", "code"], "left")
    verdict = (
        F.when(F.col("corrected").isNull() & F.col("mapped").isNull(), "unmatched").when(F.col("corrected").isNull(), "withdrawn")
        .when(F.col("mapped").isNull(), "added").when(F.col("mapped") == F.col("corrected"), "kept").otherwise("changed")
    )
    return out.withColumn("verdict", verdict).select("match_id", "field", "raw", "mapped", "code", "corrected", "verdict")
