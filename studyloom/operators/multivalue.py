"""Several values packed in one field, one row per value with its position (problem 3).

Method: quoted spans are replaced by indexed placeholders that cannot collide with the text, the remaining delimiters are
split, the spans are restored by array lookup, and the values are exploded with their positions. Everything is a built-in
expression; no Python, no shuffle.

Defined results: null, blank and separator-only cells give no row; values are trimmed and otherwise kept, repeats too;
empty values take up no position; an unclosed quote is plain text; a bracketed cell is read as a list literal (JSON or
Python style); cells of any length are split whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.session import strip

#: Private-use characters that delimit placeholders; their own occurrences in a cell are escaped first.
OPEN, CLOSE, ESC = "\ue000", "\ue001", "\ue002"
STRONG = r"[;|•\n\r\t]|(?<=\s)/(?=\s)"
QUOTED = rf'((?:^|[,;|•\n\r\t]|(?<=\s)/(?=\s))[ \u00a0]*)"((?:[^"]|"")*+)"'
LITERAL = r"""(?s)'((?:[^'\\]|\\.)*+)'|"((?:[^"\\]|\\.)*+)\""""


def _escape(c: Column) -> Column:
    c = F.regexp_replace(c, ESC, ESC + "2")
    c = F.regexp_replace(c, OPEN, ESC + "0")
    return F.regexp_replace(c, CLOSE, ESC + "1")


def _unescape(c: Column) -> Column:
    c = F.regexp_replace(c, ESC + "0", OPEN)
    c = F.regexp_replace(c, ESC + "1", CLOSE)
    return F.regexp_replace(c, ESC + "2", ESC)


def _placeholders(text: Column, pattern: str, keep: str) -> Column:
    """Replace the k-th match of pattern by OPEN k CLOSE (k from 1), keeping what ``keep`` names of the match."""
    marked = F.split(F.regexp_replace(text, pattern, f"{keep}{OPEN}{CLOSE}"), OPEN)
    return F.array_join(F.transform(marked, lambda part, i: F.when(i > 0, F.concat(F.lit(OPEN), i.cast("string"), part)).otherwise(part)), "")


def _restore(value: Column, spans: Column) -> Column:
    """Put the spans back where their placeholders stand."""
    parts = F.split(value, OPEN)

    def one(part: Column, i: Column) -> Column:
        index = F.regexp_extract(part, rf"^(\d+){CLOSE}", 1)
        rest = F.regexp_replace(part, rf"^\d+{CLOSE}", "")
        return F.when(i > 0, F.concat(F.element_at(spans, index.cast("int")), rest)).otherwise(part)

    return F.when(F.instr(value, OPEN) > 0, F.array_join(F.transform(parts, one), "")).otherwise(value)


def _plain_values(cell: Column) -> Column:
    text = _escape(strip(cell))
    spans = F.transform(F.regexp_extract_all(text, F.lit(QUOTED), F.lit(2)), lambda s: F.regexp_replace(s, '""', '"'))
    body = _placeholders(text, QUOTED, "$1")
    values = F.when(body.rlike(STRONG), F.split(body, STRONG)).otherwise(F.split(body, ","))
    return F.transform(values, lambda v: strip(_unescape(_restore(v, spans))))


def _literal_values(cell: Column) -> Column:
    inner = _escape(F.regexp_replace(strip(cell), r"^\[|\]$", ""))
    single = F.regexp_extract_all(inner, F.lit(LITERAL), F.lit(1))
    double = F.regexp_extract_all(inner, F.lit(LITERAL), F.lit(2))
    # A single-quoted span has its double quotes escaped and its escaped single quotes bared, so both kinds read as JSON.
    spans = F.zip_with(
        single, double,
        lambda s, d: F.when(d != "", d).otherwise(F.regexp_replace(F.regexp_replace(s, r"\\'", "'"), r'(?<!\\)"', r'\\"')),
    )
    plain = F.transform(spans, lambda s: F.coalesce(F.element_at(F.from_json(F.concat(F.lit('["'), s, F.lit('"]')), "array<string>"), 1), s))
    body = _placeholders(inner, LITERAL, "")
    values = F.filter(F.split(body, ","), lambda v: ~F.lower(strip(v)).isin("null", "none"))
    return F.transform(values, lambda v: strip(_unescape(_restore(v, plain))))


def split_values(cell: Column) -> Column:
    """Array of the values packed in a cell, in order; never null."""
    literal = strip(cell).rlike(r"(?s)^\[.*\]$")
    values = F.when(literal, _literal_values(cell)).otherwise(_plain_values(cell))
    return F.coalesce(F.filter(values, lambda v: v != ""), F.array().cast("array<string>"))


def explode_values(df: DataFrame, tbl: str, row_id: str, field: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(tbl, row_id, field, pos, val) for every value of one multi-valued column."""
    return df.select(
        F.lit(tbl).alias("tbl"), F.col(row_id).alias("row_id"), F.lit(field).alias("field"), *extra,
        F.posexplode(split_values(F.col(field))).alias("pos", "val"),
    ).withColumn("pos", (F.col("pos") + 1).cast("long"))


def catalogue_values(resources: DataFrame, events: DataFrame) -> DataFrame:
    """The three multi-valued columns of the catalogue as one long table."""
    return (
        explode_values(resources, "resources", "row_id", "keywords")
        .unionAll(explode_values(resources, "resources", "row_id", "countries"))
        .unionAll(explode_values(events, "collection_events", "row_id", "subpopulations"))
    )
