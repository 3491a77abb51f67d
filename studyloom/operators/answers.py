"""Answers of an extraction model and the rows made of them.

Payloads are JSON texts; whatever needs a parser runs in Arrow batches. Null, blank and unreadable payloads count as an empty
object.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from studyloom.functions import text as T
from studyloom.operators.nested import filled
from studyloom.session import strip

# The lists whose whole objects are saved from an answer that was cut off, in the order in which they are tried.
SALVAGED = ("collection_events", "subpopulations", "datasets", "samplesets", "organisations_involved", "people_involved", "publications", "documentation")
_FENCE = re.compile(r"^\s*```[A-Za-z0-9]*\s*|\s*```\s*$")
_COMMA = re.compile(r",\s*([}\]])")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}]', re.S)


def whole_objects(text: str) -> list[str]:
    """The complete outermost objects of a piece of JSON; braces within strings do not count."""
    out, depth, begin = [], 0, 0
    for m in _TOKEN.finditer(text):
        if m.group() == "{":
            begin = m.start() if depth == 0 else begin
            depth += 1
        elif m.group() == "}" and depth:
            depth -= 1
            if depth == 0:
                out.append(text[begin : m.end()])
    return out


def salvage(text: str) -> dict:
    """{list name: its whole objects} for the first known list that has any; {} if none has."""
    for name in SALVAGED:
        at = text.find(f'"{name}"')
        opened = text.find("[", at) if at >= 0 else -1
        if opened < 0:
            continue
        items = []
        for piece in whole_objects(text[opened + 1 :]):
            try:
                items.append(json.loads(piece))
            except ValueError:
                continue
        if items:
            return {name: items}
    return {}


def read_answer(answer: str | None) -> tuple[object, str]:
    """(value, how): "whole" if the answer is JSON from its first brace on, "commas" if it is without trailing commas,
    "salvaged" if list objects were saved from a cut-off answer, else ({}, "none")."""
    text = _FENCE.sub("", answer or "").strip()
    if not text.startswith("{") and "{" in text:
        text = text[text.index("{") :].strip()
    for how, tried in (("whole", text), ("commas", _COMMA.sub(r"\1", text))):
        try:
            return json.loads(tried), how
        except (ValueError, RecursionError):
            continue
    found = salvage(text)
    return found, "salvaged" if found else "none"


def answers(df: DataFrame, payload: str) -> DataFrame:
    """Rows with ``value`` (JSON text of the object read) and ``how``."""

    @F.pandas_udf("value string, how string")
    def read(col: pd.Series) -> pd.DataFrame:
        got = [read_answer(p if isinstance(p, str) else None) for p in col]
        return pd.DataFrame({"value": pd.Series([json.dumps(v, ensure_ascii=False) for v, _ in got], dtype=object), "how": pd.Series([h for _, h in got], dtype=object)})

    return df.withColumn("__a", read(F.col(payload))).select(*[F.col(f"`{c}`") for c in df.columns], "__a.value", "__a.how")


@F.pandas_udf(StringType())
def chat_content(response: pd.Series) -> pd.Series:
    """Text of the first choice of a chat response; parts of a list joined by line ends; "" if there is none."""

    def one(raw) -> str:
        try:
            content = json.loads(raw)["choices"][0]["message"].get("content", "")
        except (ValueError, TypeError, KeyError, IndexError, AttributeError):
            return ""
        if isinstance(content, list):
            parts = [p if isinstance(p, str) else p.get("text") if isinstance(p, dict) else None for p in content]
            return "\n".join(p for p in parts if isinstance(p, str) and p.strip())
        return "" if content is None else str(content)

    return pd.Series([one(r) for r in response], dtype=object)


def written(v) -> str:
    """A8: "" for null, JSON for lists and objects, else the value as text."""
    return "" if v is None else json.dumps(v, ensure_ascii=False) if isinstance(v, (list, dict)) else str(v)


def list_json(items: Column) -> Column:
    """A8 of a list of texts, without a parser: its JSON with a space behind each comma; "" for null."""
    quoted = F.transform(items, lambda x: F.when(x.isNull(), F.lit("null")).otherwise(F.regexp_replace(F.to_json(F.array(x)), r"(?s)^\[|\]$", "")))
    return F.when(items.isNull(), F.lit("")).otherwise(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def text_field(items: Column) -> Column:
    """A list in a text field as its non-blank texts joined by "; "."""
    return F.coalesce(F.array_join(list_texts(items), "; "), F.lit(""))


def list_texts(items: Column) -> Column:
    """The non-blank texts of a list; null gives []."""
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & (strip(x) != "")), F.array().cast("array<string>"))


def text_or_list(c: Column) -> Column:
    """A single value as a list of one, trimmed; blank gives []."""
    return F.when(strip(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.array(strip(c)))


def resource_ref(label: Column, pid: Column, name: Column, acronym: Column) -> Column:
    """The first of pid (without its resolver), name and acronym that is not blank, else the label."""
    some = lambda c: strip(F.coalesce(c, F.lit(""))) != ""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(pid), r"(?i)^(?:https?://)?(?:dx\.)?doi\.org/", ""), r"(?i)^doi:\s*", ""), r"[.,;:)]+$", "")
    return F.when(some(pid), bare).when(some(name), name).when(some(acronym), acronym).otherwise(label)


def default_names(c: Column) -> Column:
    """Distinct names of a default such as [{name:'x'},{name:"y"}], trimmed, in order."""
    found = lambda i: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("""name\\s*:\\s*(?:'([^']+)'|"([^"]+)")"""), F.lit(i))
    both = F.zip_with(found(1), found(2), lambda a, b: F.trim(F.when(a != "", a).otherwise(b)))
    return F.array_distinct(F.filter(both, lambda x: x != ""))


# Types, and pieces of types, that tell a health context.
HEALTH_TYPES = ("clinical trial", "cohort study", "registry", "disease specific", "health records", "biobank")
HEALTH_TOKENS = ("clinical", "cohort", "registry", "healthrecords", "biobank")


def health_context(types: Column, themes: Column, loose: bool = False) -> Column:
    """A type of the list (loose: whose letters and digits hold a token), or the theme health."""
    if loose:
        told = F.exists(list_texts(types), lambda t: F.exists(F.array(*map(F.lit, HEALTH_TOKENS)), lambda k: F.contains(T.norm_key(t), k)))
        return told | F.exists(list_texts(themes), lambda t: T.norm_key(t) == "health")
    return F.exists(list_texts(types), lambda t: F.lower(t).isin(*HEALTH_TYPES)) | F.exists(list_texts(themes), lambda t: F.lower(t) == "health")


def json_map(c: Column) -> Column:
    """Map of texts of a JSON object; an empty map for anything else."""
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.when(F.trim(F.coalesce(c, F.lit(""))).startswith("{"), F.from_json(c, "map<string,string>", {"mode": "PERMISSIVE"})), empty)


def dynamic_row(df: DataFrame, item: str, columns: list[str], field_map: dict[str, str] | None = None, resource: str = "resource", ref: Column | None = None) -> DataFrame:
    """One column each of ``columns`` from a map of texts: a key goes to the column that the field map names, else to the one
    with its letters and digits; the last such key wins, unknown keys are dropped, missing values are ""; a blank resource is ref."""
    field_map = field_map or {}
    norm = {re.sub("[^a-z0-9]+", "", c.lower()): c for c in columns}
    known = F.create_map(*[F.lit(x) for kv in field_map.items() for x in kv]) if field_map else F.create_map().cast("map<string,string>")
    loose = F.create_map(*[F.lit(x) for kv in norm.items() for x in kv])
    entries = F.transform(F.map_entries(item), lambda e: F.struct(F.coalesce(F.try_element_at(known, e["key"]), F.try_element_at(loose, T.norm_key(e["key"]))).alias("c"), e["value"].alias("v")))
    out = df.withColumn("__e", entries)
    cols = []
    last = lambda c: F.try_element_at(F.filter("__e", lambda e: e["c"] == c), F.lit(-1))["v"]
    for c in columns:
        v = F.coalesce(last(c), F.lit(""))
        cols.append((F.when(strip(v) == "", ref).otherwise(v) if c == resource and ref is not None else v).alias(c))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns and c != item], *cols)


def section_columns(df: DataFrame, sections: dict[str, list[str]]) -> DataFrame:
    """``section.key`` columns of JSON section columns, in the order of the templates; lists and objects as JSON."""

    @F.pandas_udf(ArrayType(StringType()))
    def values(*cols: pd.Series) -> pd.Series:
        out = []
        for row in zip(*cols):
            got: list[str] = []
            for (_, keys), raw in zip(sections.items(), row):
                obj, _ = read_answer(raw if isinstance(raw, str) else None)
                got += [written(obj.get(k) if isinstance(obj, dict) else None) for k in keys]
            out.append(got)
        return pd.Series(out, dtype=object)

    names = [f"{s}.{k}" for s, keys in sections.items() for k in keys]
    flat = df.withColumn("__v", values(*[F.col(f"`{s}`") for s in sections]))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in sections]
    return flat.select(*keep, *[F.col("__v")[i].alias(n) for i, n in enumerate(names)])


def names_of(items: list, fallback: str) -> list[str]:
    """P5: names of listed objects; without one the pid, without that a numbered word."""
    out = []
    for k, x in enumerate(items, 1):
        x = x if isinstance(x, dict) else {}
        out.append(str(x.get("name") or "").strip() or str(x.get("pid") or "").strip() or f"{fallback}_{k}")
    return out


def identity(item: dict) -> str:
    """Pid, else name, of an item; "" if it has neither."""
    part = lambda k: str(item.get(k) or "").strip().lower()
    return f"pid:{part('pid')}" if part("pid") else f"name:{part('name')}" if part("name") else ""


def distinct_items(items: list) -> list[dict]:
    """First item of each identity; items without identity stay, items without a value go."""
    out: dict[object, dict] = {}
    for k, x in enumerate(items):
        if isinstance(x, dict) and filled(x):
            out.setdefault(identity(x) or k, x)
    return list(out.values())


def detail_of(seed: dict, details: list) -> dict | None:
    """The detail with the seed's pid, else its name, else a name that holds or is held by it, else the first with a value."""
    low = lambda x, k: str(x.get(k) or "").strip().lower()
    pid, name = low(seed, "pid"), low(seed, "name")
    rules = (
        lambda d: bool(pid) and low(d, "pid") == pid, lambda d: bool(name) and low(d, "name") == name,
        lambda d: bool(name) and bool(low(d, "name")) and (name in low(d, "name") or low(d, "name") in name), filled,
    )
    return next((d for rule in rules for d in details if isinstance(d, dict) and rule(d)), None)


def overlaid(seed: dict, detail: dict | None) -> dict:
    """The seed with those values of the detail that are not empty."""
    return seed | {k: v for k, v in (detail or {}).items() if filled(v)}
