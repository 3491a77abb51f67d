"""Resolution of free values to the entries of a list: choices, places, external organisations, model-backed choice.

Every distinct value is resolved once and joined back to its rows, a hot value by broadcast. Results are (raw, mapped, method,
suggestions). Lists have no row order here, so where the order of a list decides, the order of its names does. Null and blank
values have the method "empty"; an empty list leaves every value unmapped; repeated list rows count once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import text as T
from studyloom.functions.arrays import scalar_of
from studyloom.operators import relational as R
from studyloom.operators.fuzzy import fuzzy_match
from studyloom.operators.inference import Factory
from studyloom.operators.nested import read_object
from studyloom.operators.skew import join_hot
from studyloom.session import cut, strip

CUTOFF, MARGIN = 0.96, 0.02
REGION_CUTOFF = 0.95
# Other names of countries and regions, and the entry that each stands for if the list has it.
_UK, _US = "United Kingdom of Great Britain and Northern Ireland (the)", "United States of America (the)"
COUNTRY_ALIASES = {
    "the netherlands": "Netherlands (the)", "netherlands": "Netherlands (the)", "holland": "Netherlands (the)", "uk": _UK, "u k": _UK, "united kingdom": _UK,
    "great britain": _UK, "england": _UK, "us": _US, "u s": _US, "usa": _US, "united states": _US, "united states of america": _US,
    "czech republic": "Czechia", "ivory coast": "Côte d'Ivoire", "south korea": "Korea (the Republic of)", "north korea": "Korea (the Democratic People's Republic of)",
    "russia": "Russian Federation (the)", "laos": "Lao People's Democratic Republic (the)", "syria": "Syrian Arab Republic (the)", "iran": "Iran (Islamic Republic of)",
    "moldova": "Moldova (the Republic of)", "venezuela": "Venezuela (Bolivarian Republic of)", "tanzania": "Tanzania, the United Republic of",
    "palestine": "Palestine, State of", "vietnam": "Viet Nam", "brunei": "Brunei Darussalam",
}
REGION_ALIASES = {"eu": "European Union", "european union eu": "European Union"}
TOKENS = ("name", "label", "acronym", "code", "ontology_term_uri", "id")


def _clean(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def choice_stages(entries: DataFrame, tokens: tuple[str, ...] = TOKENS) -> list[tuple[str, DataFrame, object]]:
    """Indexes of a list for ``relational.resolve``: exact token, normalised token, normalised name; ambiguous keys left out."""
    named = entries.withColumn("name", _clean(F.col("name"))).filter("name <> ''")
    have = [t for t in tokens if t in entries.columns]
    return [
        ("exact", R.unambiguous_index(named, "name", have, _clean), _clean),
        ("normalized", R.unambiguous_index(named, "name", have, T.norm_key), T.norm_key),
        ("normalized_canonical", R.unambiguous_index(named, "name", ["name"], T.norm_key), T.norm_key),
    ]


def place_stages(entries: DataFrame, country: bool) -> list[tuple[str, DataFrame, object]]:
    """Indexes of a place list: code, name without case, alias, normalised name (also without "the" before it)."""
    named = entries.select(_clean(F.col("name")).alias("name"), F.upper(_clean(F.col("code"))).alias("code")).filter("name <> ''")
    key = lambda c: T.geo_key(c, country)
    last = lambda k: named.select(k.alias("k"), "name").filter("k <> ''").groupBy("k").agg(F.max("name").alias("canonical"))
    norm = key(F.col("name"))
    forms = F.array(norm, F.trim(F.regexp_replace(norm, r"^the\s+", ""))) if country else F.array(norm)
    first = named.select(F.explode(forms).alias("k"), "name").filter("k <> ''").groupBy("k").agg(F.min("name").alias("canonical"))
    aliases = COUNTRY_ALIASES if country else REGION_ALIASES
    known = entries.sparkSession.createDataFrame(sorted(aliases.items()), "k string, name string").join(named.select("name").distinct(), "name")
    return [
        ("code", last(F.col("code")), lambda c: F.upper(_clean(c))), ("exact_name", last(F.lower("name")), lambda c: F.lower(_clean(c))),
        ("alias", known.select("k", F.col("name").alias("canonical")), key), ("normalized_name", first, key),
    ]


def match_values(values: DataFrame, raw: str, stages: list, cutoff: float = CUTOFF, margin: float = MARGIN, fuzzy: bool = True) -> DataFrame:
    """(raw, mapped, method, suggestions) of each distinct value: the first stage that knows it, else the best key
    of the last stage if it is close enough and clear, else unmapped with suggestions."""
    last_name, last_index, last_key = stages[-1]
    known = values.select(_clean(F.col(raw)).alias("raw")).distinct()
    done = R.resolve(known, "raw", stages, into="mapped")
    empty = F.when(F.col("raw") == "", F.lit("empty"))
    none = F.array().cast("array<string>")
    if not fuzzy:
        return done.select("raw", "mapped", F.coalesce(empty, F.col("method")).alias("method"), none.alias("suggestions"))
    done = cut(done.withColumn("key", last_key(F.col("raw"))))
    rest = done.filter("mapped IS NULL AND key <> ''").select("key")
    near = fuzzy_match(rest, "key", last_index.select(F.col("k").alias("key"), "canonical"), cutoff, margin)
    both = done.join(near.withColumnRenamed("canonical", "near"), "key", "left")
    found = F.coalesce("mapped", "near")
    method = (
        F.when(F.col("raw") == "", "empty").when(F.col("mapped").isNotNull(), F.col("method")).when(F.col("key") == "", "empty_normalized")
        .when(F.col("near").isNotNull(), "fuzzy_auto").otherwise("unmapped")
    )
    return both.select("raw", found.alias("mapped"), method.alias("method"), F.when(found.isNull(), F.coalesce("suggestions", none)).otherwise(none).alias("suggestions"))


def with_matches(rows: DataFrame, raw: str, matches: DataFrame) -> DataFrame:
    """Rows with mapped, method and suggestions of their value."""
    keyed = rows.withColumn("__raw", _clean(F.col(raw)))
    counts = cut(keyed.groupBy("__raw").agg(F.count(F.lit(1)).alias("n")))
    return join_hot(keyed, matches.withColumnRenamed("raw", "__raw"), ["__raw"], counts).drop("__raw")


def external_organisations(rows: DataFrame, organisation: str, other: str, entries: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Organisation mapped to the external list, else the other organisation; a hit overwrites the first and clears the
    second, a miss clears the first and moves it to the second if that is blank."""
    stages = choice_stages(entries)[:2]
    values = rows.select(F.col(organisation).alias("v")).unionByName(rows.select(F.col(other).alias("v")))
    found = cut(match_values(values, "v", stages, fuzzy=fuzzy).filter("mapped IS NOT NULL").select("raw", "mapped"))
    both = with_matches(rows, organisation, found.withColumnRenamed("mapped", "__a"))
    both = with_matches(both, other, found.withColumnRenamed("mapped", "__b"))
    hit, own, alt = F.coalesce("__a", "__b"), _clean(F.col(organisation)), _clean(F.col(other))
    moved = F.when(hit.isNotNull(), "").when((own != "") & (alt == ""), own).otherwise(alt)
    return both.withColumn("__o", F.coalesce(hit, F.lit(""))).withColumn(other, moved).withColumn(organisation, F.col("__o")).drop("__a", "__b", "__o")


def ontology_or_static(raw: Column, mapped: Column, sourced: Column, static: list[str] | None) -> Column:
    """Of a column with a list, the mapped value or ""; of one without, the value if its fixed set has it (any value if it has no set)."""
    own = scalar_of(raw)
    legacy = F.when(own.isin(*static), own).otherwise("") if static else own
    return F.when(sourced, F.coalesce(mapped, F.lit(""))).otherwise(legacy)


def map_list_cells(cells: DataFrame, row_no: str, items: str, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((row_no, cell), issues): list cells with their values mapped in place, joined by bare commas, an unmapped one kept as
    typed; and (row_no from 2 for the first row, raw, suggestions) of the unmapped ones. row_no counts from 1."""
    long = cells.select(row_no, F.posexplode(items).alias("pos", "raw"))
    met = with_matches(long, "raw", matches)
    cell = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("mapped", "raw").alias("v")))), lambda s: s["v"]), ",")
    issues = met.filter("mapped IS NULL AND method <> 'empty'").select((F.col(row_no) + 1).alias(row_no), "raw", F.array_join("suggestions", " | ").alias("suggestions"))
    return met.groupBy(row_no).agg(cell.alias("cell")), issues


def organisations_source(registry: DataFrame) -> DataFrame:
    """(source) of the column ``organisation`` of the first of Organisations and Agents that has one. registry: (tbl, col, source)."""
    hit = registry.filter("lower(col) = 'organisation' AND tbl IN ('Organisations', 'Agents') AND trim(coalesce(source, '')) <> ''")
    return hit.agg(F.min_by("source", F.when(F.col("tbl") == "Organisations", 0).otherwise(1)).alias("source")).filter("source IS NOT NULL")


def choose_with_model(unmapped: DataFrame, factory: Factory, list_size: int, threshold: int = 16, most: int = 5, budget: int = 50) -> DataFrame:
    """(raw, choice, method) of unmapped values of a list longer than the threshold: the model picks one of at most ``most``
    suggestions; anything else counts as no choice. At most ``budget`` values are asked, in order (a bound of the feature)."""
    if list_size <= threshold:
        return unmapped.select("raw", F.lit(None).cast("string").alias("choice"), F.lit("unmapped").alias("method"))
    asked = unmapped.filter(F.size("suggestions") > 0).orderBy("raw").limit(budget).select("raw", F.slice("suggestions", 1, most).alias("suggestions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for b in batches:
            rows = []
            for raw, names in zip(b["raw"], b["suggestions"]):
                names = list(names)
                prompt = f"Value: {raw}\nChoices: {json.dumps(names, ensure_ascii=False)}\n" + 'Answer {"choice": one of the choices or null}'
                try:
                    answer = (read_object(client(prompt)) or {}).get("choice")
                except Exception:  # noqa: BLE001 - a failing model makes no choice
                    answer = None
                rows.append((raw, answer if answer in names else None))
            yield pd.DataFrame(rows, columns=["raw", "choice"], dtype=object)

    picked = asked.mapInPandas(run, "raw string, choice string")
    return unmapped.select("raw").join(picked, "raw", "left").select("raw", "choice", F.when(F.col("choice").isNotNull(), "llm").otherwise("unmapped").alias("method"))
