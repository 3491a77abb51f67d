"""Arrays, lists in text and JSON as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from studyloom.session import strip


def dedupe_ci(arr: Column) -> Column:
    """A5: first of each value without case and outer space; blanks dropped."""
    keep = F.filter(arr, lambda x: x.isNotNull() & (F.trim(x) != ""))
    keys = F.transform(keep, lambda x: F.lower(F.trim(x)))
    return F.transform(F.array_distinct(keys), lambda k: F.element_at(keep, F.array_position(keys, k).cast("int")))


def csv_join(arr: Column) -> Column:
    """Comma join, values with quotes, commas or line ends quoted, quotes doubled."""
    quote = lambda x: F.when(x.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)
    return F.array_join(F.transform(arr, quote), ",")


def parse_list(c: Column) -> Column:
    """A1: JSON list, else a CSV row, else the single value; items trimmed, blanks dropped."""
    t = strip(F.coalesce(c, F.lit("")))
    json = F.when(t.rlike(r"(?s)^\[.*\]$"), F.from_json(t, "array<string>"))
    fields = F.regexp_extract_all(F.concat(F.lit(","), t), F.lit(r',\s*("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    csv = F.transform(fields, lambda x: F.when(strip(x).rlike('(?s)^".*"$'), F.replace(F.regexp_replace(strip(x), '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.filter(F.transform(F.coalesce(json, csv), strip), lambda x: x.isNotNull() & (x != ""))


def parse_list_loose(c: Column) -> Column:
    """A4: as parse_list; a single item is split again at ";", "|" and line ends."""
    items = parse_list(c)
    again = F.filter(F.transform(F.split(F.element_at(items, 1), r"[;\n|]+"), strip), lambda x: x != "")
    return F.when(F.size(items) == 1, again).otherwise(items)


def allowed_only(arr: Column, allowed: list[str]) -> Column:
    """A3: labels of the list as it writes them, compared without case; distinct."""
    table = F.create_map(*[F.lit(x) for a in allowed for x in (a.lower(), a)])
    return F.array_distinct(F.array_compact(F.transform(arr, lambda x: F.try_element_at(table, F.lower(strip(x))))))


def scalar_of(c: Column, keys: tuple[str, ...] = ("name", "id", "label", "value")) -> Column:
    """The scalar in a value that may be a JSON object or list, or wear stray brackets and quotes."""
    t = strip(F.coalesce(c, F.lit("")))
    in_object = F.coalesce(*[F.nullif(F.get_json_object(t, f"$.{k}"), F.lit("")) for k in keys])
    in_list = F.try_element_at(F.filter(F.from_json(t, "array<string>"), lambda x: strip(x) != ""), F.lit(1))
    bare = strip(F.regexp_replace(F.regexp_replace(t, r"""^[\[\]"'\\\s]+""", ""), r"""[\[\]"'\\\s]+$""", ""))
    return F.when(t.startswith("{"), F.coalesce(in_object, F.lit(""))).when(t.startswith("["), F.coalesce(in_list, bare)).otherwise(bare)


def add_default(arr: Column, label: str, when: Column) -> Column:
    """The label appended if absent (without case) and the condition holds."""
    have = F.exists(arr, lambda x: F.lower(F.trim(x)) == label.lower())
    return F.when(when & ~have, F.concat(arr, F.array(F.lit(label)))).otherwise(arr)


def backfill(parent: Column, children: Column) -> Column:
    """The parent list, or the union of the children's lists if it is empty."""
    return F.when(F.size(parent) > 0, parent).otherwise(dedupe_ci(F.flatten(F.filter(children, lambda x: x.isNotNull()))))


def lenient_json(c: Column) -> Column:
    """Text of the JSON object in a model's answer: fences off, from the first brace, stray trailing commas off."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s*```[A-Za-z0-9]*\s*", ""), r"\s*```\s*$", "")
    t = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.nullif(F.regexp_replace(t, r'("(?:[^"\\]|\\.)*+")|,(?=\s*[}\]])', "$1"), F.lit(""))


def truth(c: Column) -> Column:
    """Texts "true", "false", "null" and "" as booleans or null, everything else as it is (as text)."""
    low = F.lower(strip(c))
    return F.when(low.isin("", "null"), F.lit(None)).when(low.isin("true", "false"), low).otherwise(c)


def has_value(*cols: Column) -> Column:
    """Any of the columns (as text) is not blank; numbers and booleans count, also 0 and false."""
    out = F.lit(False)
    for c in cols:
        out = out | (strip(F.coalesce(c.cast("string"), F.lit(""))) != "")
    return out
