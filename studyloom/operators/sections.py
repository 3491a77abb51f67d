"""Repairs of a paper's sections from its own text and from each other (M13, M14): one row a paper, built-in expressions only.

Rules act on the columns that are there, in the order below. Null and blank count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import arrays as A
from studyloom.functions import text as T
from studyloom.operators.answers import default_names, health_context, list_texts
from studyloom.operators.repair import adult_age
from studyloom.session import strip

# Words that make a name more than the title of an article; remarks of a journal that are no provenance; the
# default theme and law of health resources.
LABEL = r"(?i)\b(study|cohort|biobank|registry|trial|database|databank|network)\b"
EDITORIAL = r"(?i)not commissioned|peer reviewed"
THEME, LAW = "Health", "Data Governance Act"


def _empty(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit(""))) == ""


def _some(xs: Column) -> Column:
    return F.size(list_texts(xs)) > 0


def with_law(laws: Column, health: Column, law: str = LAW) -> Column:
    """The law behind the others, in a health context that lacks it."""
    have = F.exists(list_texts(laws), lambda x: F.lower(x) == law.lower())
    return F.when(health & ~have, A.dedupe_ci(F.concat(list_texts(laws), F.array(F.lit(law))))).otherwise(laws)


def repaired_sections(df: DataFrame, text: str) -> DataFrame:
    """M14. Columns that are read if they are there: types, themes, laws, titles, groups, areas (arrays), event_areas (array of arrays),
    age_min, number_of_participants, access_rights, access_description, data_access_fee, linkage_options, pid, name, provenance;
    text gives the evidence. datasets and samplesets (arrays of names) and sample_types are filled where they are empty lists."""
    t = F.col(text)
    has = set(df.columns)
    none = F.array().cast("array<string>")
    col = lambda c, other=none: F.col(c) if c in has else other
    health = health_context(col("types"), col("themes"))
    new: dict[str, Column] = {}
    if {"age_min", "groups"} <= has:
        new["age_min"] = adult_age(F.col("age_min"), F.col("groups"))
    if "number_of_participants" in has:
        new["number_of_participants"] = F.coalesce("number_of_participants", T.participant_hint(t))
    if "access_rights" in has:
        new["access_rights"] = T.access_rights(F.col("access_rights"), t)
    if "access_description" in has:
        new["access_description"] = F.when(_empty(F.col("access_description")), F.coalesce(T.sentence_with(t), F.col("access_description"))).otherwise(F.col("access_description"))
    if "data_access_fee" in has:
        new["data_access_fee"] = T.access_fee(F.col("data_access_fee"), t)
    if "linkage_options" in has:
        kept = T.drop_tokens(F.col("linkage_options"), T.OUTCOMES)
        new["linkage_options"] = F.when(_empty(F.col("linkage_options")), F.col("linkage_options")).otherwise(F.nullif(kept, F.lit("")))
    if "datasets" in has:
        new["datasets"] = F.when(F.size("datasets") == 0, T.dataset_hints(t)).otherwise(F.col("datasets"))
    if {"samplesets", "sample_types"} <= has:
        name, kinds = T.sampleset_name(T.normalize_ws(t)), T.sample_types(T.normalize_ws(t))
        told = (F.size("samplesets") == 0) & name.isNotNull() & (F.size(kinds) > 0)
        new["samplesets"] = F.when(told, F.array(name)).otherwise(F.col("samplesets"))
        new["sample_types"] = F.when(told, kinds).otherwise(F.col("sample_types"))
    if "pid" in has:
        new["pid"] = F.when(_empty(F.col("pid")), F.coalesce(T.first_doi(T.normalize_ws(t)), F.col("pid"))).otherwise(F.col("pid"))
    if {"areas", "event_areas"} <= has:
        new["areas"] = F.when(_some(F.col("areas")), F.col("areas")).otherwise(A.backfill(none, F.coalesce("event_areas", F.array(none))))
    if "themes" in has:
        new["themes"] = F.when(health & ~_some(F.col("themes")), F.array(F.lit(THEME))).otherwise(F.col("themes"))
    if "provenance" in has:
        new["provenance"] = F.when(F.col("provenance").rlike(EDITORIAL), F.lit(None)).otherwise(F.col("provenance"))
    if "laws" in has:
        new["laws"] = with_law(F.col("laws"), health)
    if {"name", "titles"} <= has:
        own = F.lower(strip(F.coalesce("name", F.lit(""))))
        as_title = (own != "") & F.exists(list_texts(F.col("titles")), lambda x: F.lower(strip(x)) == own) & ~F.col("name").rlike(LABEL)
        new["name"] = F.when(as_title, F.lit(None)).otherwise(F.col("name"))
    return df.withColumns(new)


def schema_defaults(df: DataFrame, text: str, rights: Column, theme_default: Column, law_default: Column) -> DataFrame:
    """As the model's own lists and defaults say: blank access_rights of a text that tells access on request is the first label
    of ``rights`` that names restricted or controlled access; in a health context (loose) empty themes take the default themes,
    and default laws that are missing stand behind the others."""
    health = health_context(F.col("types"), F.col("themes"), loose=True)
    on_request = F.coalesce(F.col(text), F.lit("")).rlike(f"(?i){T.ON_REQUEST}")
    label = T.pick_allowed(rights, "restricted", "controlled")
    laws, more = list_texts(F.col("laws")), default_names(law_default)
    return df.withColumns({
        "access_rights": F.when(_empty(F.col("access_rights")) & on_request, F.coalesce(label, F.col("access_rights"))).otherwise(F.col("access_rights")),
        "themes": F.when(health & (F.size("themes") < 1) & (F.size(default_names(theme_default)) > 0), default_names(theme_default)).otherwise(F.col("themes")),
        "laws": F.when(health & (F.size(more) > 0), F.concat(laws, F.filter(more, lambda x: ~F.array_contains(laws, x)))).otherwise(F.col("laws")),
    })
