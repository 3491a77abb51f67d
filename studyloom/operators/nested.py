"""Nested semi-structured records into related flat tables with parent-child links (problem 1).

Method: a lenient reader brings each payload into one canonical typed shape; nested ``transform`` calls then attach
ancestor keys and indices, ``flatten`` joins the arrays of a record, and one ``inline`` per target table emits rows.
Nothing is shuffled: every record is unfolded where it is read.

Defined results: a null, blank, cut-off or unreadable payload gives no row; an entry that is no object, or an object
without a value, keeps its place in the numbering but gives no row; further columns of the input are not read, so
clashing names cannot matter; repeated records give repeated rows under their own record id; an empty input gives empty
tables.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STRAY = re.compile(r'("(?:[^"\\]|\\.)*")|,+(?=\s*(?:,\s*)*[}\]])', re.S)
_FENCE = re.compile(r"^\s*```\w*\s*|\s*```\s*$")


@dataclass(frozen=True)
class Level:
    """One list in the record: its key, the scalar fields kept of an entry, the lists nested in an entry, and the column (if
    any) that takes all other values of an entry as JSON."""

    key: str
    fields: tuple[str, ...]
    children: tuple["Level", ...] = field(default=())
    rest: str = ""

    def columns(self) -> tuple[str, ...]:
        return (*self.fields, self.rest) if self.rest else self.fields

    def ddl(self) -> str:
        parts = ["pos INT"] + [f"`{f}` STRING" for f in self.columns()] + [f"`{c.key}` {c.ddl()}" for c in self.children]
        return f"ARRAY<STRUCT<{', '.join(parts)}>>"


def letters(key: str) -> str:
    """Keys compare by their letters and digits without case."""
    return "".join(ch for ch in key.lower() if ch.isalnum())


def filled(v) -> bool:
    """True if any leaf at any depth is a value: not null and not a blank string."""
    if isinstance(v, dict):
        return any(filled(x) for x in v.values())
    if isinstance(v, list):
        return any(filled(x) for x in v)
    return v is not None and (not isinstance(v, str) or bool(v.strip()))


def loads(text: str):
    """JSON with stray trailing commas allowed; None if it is no JSON."""
    try:
        return json.loads(text, strict=False)
    except (ValueError, RecursionError):
        pass
    try:
        return json.loads(_STRAY.sub(lambda m: m.group(1) or "", text), strict=False)
    except (ValueError, RecursionError):
        return None


_OBJECT = re.compile(r'\{\s*["}]')
_PIECE = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]|"', re.S)


def _balanced(text: str, start: int) -> int:
    """End of the object that opens at start, or -1 if it is never closed."""
    depth = 0
    for m in _PIECE.finditer(text, start):
        tok = m.group()
        if tok == "{":
            depth += 1
        elif tok == "}":
            depth -= 1
            if depth == 0:
                return m.end()
        elif tok == '"':  # a string that is never closed
            return -1
    return -1


def read_object(payload: str | None) -> dict | None:
    """The object in a payload: bare, as a JSON string (at any depth), or within other text; None for a cut-off or unreadable one."""
    if not payload:
        return None
    text = _FENCE.sub("", payload.strip("﻿ \t\r\n"))
    got = loads(text)
    if isinstance(got, str):
        return read_object(got)
    if isinstance(got, dict):
        return got
    at = text.find("{")
    while at >= 0:
        end = _balanced(text, at)
        if end < 0:
            # An opening brace of the text around, not of an object, may precede it.
            nxt = text.find("{", at + 1)
            if nxt < 0 or _OBJECT.match(text, at):
                break
            at = nxt
            continue
        got = loads(text[at:end])
        if isinstance(got, dict) and (got or end >= len(text) - 3):
            return got
        at = text.find("{", end)
    quote = text.find('"')  # a JSON string within other text
    if quote >= 0 and quote + 1 < len(text) and (m := _PIECE.match(text, quote)) and len(m.group()) > 2:
        inner = loads(m.group())
        if isinstance(inner, str) and "{" in inner:
            return read_object(inner)
    return None


def _by_letters(obj: dict) -> dict:
    out: dict = {}
    for k, v in obj.items():
        n = letters(str(k))
        if n not in out or (out[n] is None and v is not None):
            out[n] = v
    return out


def _as_list(v):
    """A list; a lone object as a list of one; a list written as JSON text; anything else is no list."""
    if isinstance(v, str):
        v = loads(v.strip()) if v.strip().startswith("[") else None
        return v if isinstance(v, list) else []
    if isinstance(v, dict):
        return [v]
    return v if isinstance(v, list) else []


def _text(v) -> str | None:
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float) and v.is_integer() and abs(v) < 1e15:
        return str(int(v))
    return str(v) if isinstance(v, (int, float)) else json.dumps(v, ensure_ascii=False)


def _unlisted(item: dict, at: dict, level: Level) -> str | None:
    """JSON of the values of an entry that no field and no nested list takes; null if there are none."""
    fields, lists = ({letters(x) for x in xs} for xs in (level.fields, (c.key for c in level.children)))
    out = {}
    for k, v in item.items():
        n = letters(str(k))
        taken = at[n] is v and (n in fields or n in lists and bool(_as_list(v)))
        if filled(v) and not taken:
            out[str(k)] = v
    return json.dumps(out, ensure_ascii=False) if out else None


def _canonical(items, level: Level) -> list[dict]:
    out = []
    for pos, item in enumerate(_as_list(items), 1):
        if not isinstance(item, dict) or not filled(item):
            continue
        at = _by_letters(item)
        row = {"pos": pos} | {f: _text(at.get(letters(f))) for f in level.fields}
        if level.rest:
            row[level.rest] = _unlisted(item, at, level)
        for child in level.children:
            row[child.key] = _canonical(at.get(letters(child.key)), child)
        out.append(row)
    return out


def canonical_lists(payload: str | None, levels: tuple[Level, ...]) -> dict[str, list]:
    """All lists of a payload in the canonical shape; the object may stand in one outer object."""
    obj = read_object(payload)
    out: dict[str, list] = {level.key: [] for level in levels}
    if obj is None:
        return out
    wanted = {letters(level.key) for level in levels}
    own = _by_letters(obj)
    if not wanted & own.keys():
        for v in obj.values():
            inner = v if isinstance(v, dict) else read_object(v) if isinstance(v, str) and "{" in v else None
            if inner is not None and wanted & (at := _by_letters(inner)).keys():
                own = at
                break
    for level in levels:
        out[level.key] = _canonical(own.get(letters(level.key)), level)
    return out


def read_nested(df: DataFrame, payload: str, task: str, levels: dict[str, tuple[Level, ...]], into: str = "nested") -> DataFrame:
    """Add one typed column with the canonical lists that the task of each payload has (Arrow batches; no shuffle); the lists of
    other tasks are null."""

    @F.pandas_udf("string")
    def canon(tasks: pd.Series, col: pd.Series) -> pd.Series:
        found = [json.dumps(canonical_lists(p, levels[t]), ensure_ascii=False) if t in levels else None for t, p in zip(tasks, col)]
        return pd.Series(found, dtype=object)

    ddl = "STRUCT<" + ", ".join(f"`{level.key}`: {level.ddl()}" for own in levels.values() for level in own) + ">"
    return df.withColumn(into, F.from_json(canon(F.col(task), F.col(payload)), ddl))


def project_level(df: DataFrame, keys: list[str], nested: str, level: Level) -> DataFrame:
    """Flat table of a top list: record keys, outer_pos and the entry's fields."""
    fields = ", ".join(f"e.`{f}` AS `{f}`" for f in level.columns())
    own = ", ".join(f"`{k}` AS `{k}`" for k in keys)
    return df.selectExpr(
        f"inline(transform(`{nested}`.`{level.key}`, e -> struct({own}, e.pos AS outer_pos, {fields})))"
    )


def project_child(df: DataFrame, keys: list[str], nested: str, level: Level, child: Level, parent: tuple[str, ...]) -> DataFrame:
    """Flat table of a nested list: record keys, both positions, the named parent fields (prefixed) and the own fields."""
    own = ", ".join(f"`{k}` AS `{k}`" for k in keys)
    up = "".join(f", e.`{p}` AS `parent_{p}`" for p in parent)
    fields = ", ".join(f"c.`{f}` AS `{f}`" for f in child.fields)
    return df.selectExpr(
        f"inline(flatten(transform(`{nested}`.`{level.key}`, e -> transform(e.`{child.key}`, c -> "
        f"struct({own}, e.pos AS outer_pos, c.pos AS inner_pos{up}, {fields})))))"
    )


COUNTS = Level("counts", ("age_group", "n_total", "n_female", "n_male"))
SUBPOPULATIONS = Level(
    "subpopulations",
    ("name", "pid", "description", "number_of_participants", "inclusion_start", "inclusion_end", "age_min", "age_max",
     "age_groups", "countries", "regions", "keywords", "inclusion_criteria"),
    (COUNTS,),
    "rest",
)
EXTERNAL = Level("external_identifiers", ("identifier", "type", "type_other"))


LEVELS = {"task_overview": (EXTERNAL,), "task_subpopulations": (SUBPOPULATIONS,)}


def _sections(sections: DataFrame, *tasks: str) -> DataFrame:
    """Sections of the tasks with their lists: every payload is read once."""
    base = sections.filter(F.col("task").isin(*tasks)).select("section_id", "resource", "task", "payload")
    return read_nested(base, "payload", "task", {t: LEVELS[t] for t in tasks})


def section_tables(sections: DataFrame) -> dict[str, DataFrame]:
    """The three flat tables of section_results: external_identifiers, subpopulations and counts."""
    keys = ["section_id", "resource"]
    over, subs = _sections(sections, "task_overview"), _sections(sections, "task_subpopulations")
    return {
        "external_identifiers": project_level(over, keys, "nested", EXTERNAL),
        "subpopulations": project_level(subs, keys, "nested", SUBPOPULATIONS),
        "counts": project_child(subs, keys, "nested", SUBPOPULATIONS, COUNTS, ("name", "pid")),
    }


def section_entries(sections: DataFrame) -> DataFrame:
    """(section_id, list_name, outer_pos, inner_pos) of every filled entry of the three lists: one table, so one inline."""
    place = lambda name, outer, inner: f"struct(section_id, '{name}' AS list_name, CAST({outer} AS BIGINT) AS outer_pos, CAST({inner} AS BIGINT) AS inner_pos)"
    lists = [
        f"transform(nested.external_identifiers, e -> {place('external_identifiers', 'e.pos', '0')})",
        f"transform(nested.subpopulations, e -> {place('subpopulations', 'e.pos', '0')})",
        f"flatten(transform(nested.subpopulations, e -> transform(e.counts, c -> {place('counts', 'e.pos', 'c.pos')})))",
    ]
    return _sections(sections, *LEVELS).selectExpr(f"inline(flatten(filter(array({', '.join(lists)}), x -> x IS NOT NULL)))")
