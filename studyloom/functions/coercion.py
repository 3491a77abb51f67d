"""Typed values from messy text (N1-N14, N16): Column expressions that give null (or "") for what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.functions import arrays
from studyloom.session import strip

# Date forms in the order in which they are tried.
FORMATS = (
    "yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "yyyy-M-d H:m", "yyyy-M-d H:m:s", "yyyy/M/d H:m", "yyyy/M/d H:m:s", "d/M/yyyy H:m", "d/M/yyyy H:m:s", "yyyy-M-d H:m:s.SSSSSS",
)
#: ISO forms beyond them.
ISO = ("yyyyMMdd", "yyyyMMdd HH", "yyyyMMdd HHmm", "yyyyMMdd HHmmss", "yyyy-MM-dd HH", "yyyy-MM-dd HHmm", "yyyy-MM-dd HHmmss")


def _clean(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def _week_date(t: Column) -> Column:
    """Date of an ISO week: 2020-W05, 2020-W05-1, 2020W051."""
    form = r"^(\d{4})(?:-W(0[1-9]|[1-4]\d|5[0-3])(?:-([1-7]))?|W(0[1-9]|[1-4]\d|5[0-3])([1-7])?)$"
    part = lambda i: F.regexp_extract(t, form, i)
    week, day = F.concat(part(2), part(4)).cast("int"), F.coalesce(F.concat(part(3), part(5)).try_cast("int"), F.lit(1))
    monday = F.trunc(F.try_make_timestamp(part(1).try_cast("int"), F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0)), "week")
    return F.when(t.rlike(form), F.date_add(monday, (week - 1) * 7 + day - 1).cast("timestamp"))


def to_datetime(c: Column) -> Column:
    """Every "T" read as a space and "Z" left out; first form that fits, else an ISO form, else the ISO date at the beginning (an offset behind it is passed over); null if none."""
    t = F.regexp_replace(F.replace(F.replace(_clean(c), F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit("")), r"\s+", " ")
    head = F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}(?::\d{2})?)?)", 1)
    read = lambda x, f: F.try_to_timestamp(x, F.lit(f))
    tries = [read(t, f) for f in (*FORMATS, *ISO)] + [_week_date(t)] + [read(head, f) for f in ("yyyy-MM-dd", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss")]
    return F.when(t != "", F.coalesce(*tries))


def to_date_text(c: Column) -> Column:
    """N2"""
    return F.coalesce(F.date_format(to_datetime(c), "yyyy-MM-dd"), F.lit(""))


def to_datetime_text(c: Column) -> Column:
    """N3"""
    return F.coalesce(F.date_format(to_datetime(c), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def int_text(c: Column, non_negative: bool = False) -> Column:
    """Digits of a whole number of any length, also written as "12.0" (read as a float, as far as 64 bits go); null else."""
    t = _clean(c)
    plain = F.regexp_extract(t, r"^([+-]?\d+)$", 1)
    point = F.regexp_extract(t, r"^([+-]?\d+)\.0+$", 1)
    as_float = F.coalesce(F.when(F.abs(point.try_cast("double")) < 9.2e18, point.try_cast("double").cast("long")).cast("string"), point)
    raw = F.when(plain != "", plain).when(point != "", as_float)
    digits = F.regexp_replace(F.regexp_replace(raw, r"^[+-]", ""), r"^0+(?=\d)", "")
    v = F.when(raw.startswith("-") & (digits != "0"), F.concat(F.lit("-"), digits)).otherwise(digits)
    return F.when(~v.startswith("-"), v) if non_negative else v


def to_int(c: Column, non_negative: bool = False) -> Column:
    """N4 as a 64-bit number; null also beyond 64 bits (int_text keeps those)."""
    return int_text(c, non_negative).try_cast("long")


def to_bool(c: Column) -> Column:
    """N5"""
    t = F.lower(_clean(c))
    return F.when(t.isin("true", "1", "yes", "y"), F.lit("true")).when(t.isin("false", "0", "no", "n"), F.lit("false")).otherwise(F.lit(""))


def to_bool_or_false(c: Column) -> Column:
    """N6"""
    return F.when(to_bool(c) == "true", F.lit("true")).otherwise(F.lit("false"))


def to_email(c: Column) -> Column:
    """N7"""
    return F.when(_clean(c).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), _clean(c)).otherwise(F.lit(""))


# Forms of addresses.
_SITE = r"^(?:https?://|www\.)[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::\d+)?(?:[/?#]\S*)?$"
_BARE = r"^[A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::\d+)?(?:[/?#]\S*)?$"


def to_hyperlink(c: Column, doi: bool = False) -> Column:
    """A site as it stands, "https://" before a "www." name or a bare domain; in a DOI column the resolver's address of a DOI; "" else."""
    t = _clean(c)
    if doi:
        bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?i)^(?:https?://)?(?:dx\.)?doi\.org/", ""), r"(?i)^doi:\s*", ""), r"[.,;:)]+$", "")
        return F.when(bare.rlike(r"^10\.\d{4,9}/[-._;()/:A-Za-z0-9]+$"), F.concat(F.lit("https://doi.org/"), bare)).otherwise(F.lit(""))
    https = F.concat(F.lit("https://"), t)
    return F.when(t.rlike(_SITE), F.when(t.startswith("www."), https).otherwise(t)).when(t.rlike(_BARE), https).otherwise(F.lit(""))


def coerce(kind: str, c: Column, allowed: list[str] | None = None) -> Column:
    """Text of a value of a column type; "" where nothing fits."""
    empty = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    if kind in ("file", "heading", "refback"):
        return F.lit("")
    if kind == "int":
        return empty(int_text(c))
    if kind == "non_negative_int":
        return empty(int_text(c, True))
    if kind == "bool":
        return to_bool(c)
    if kind == "date":
        return to_date_text(c)
    if kind == "datetime":
        return to_datetime_text(c)
    if kind == "email":
        return to_email(c)
    if kind == "hyperlink":
        return to_hyperlink(c)
    if kind == "ontology" and allowed is not None:
        return F.when(arrays.scalar_of(c).isin(*allowed), arrays.scalar_of(c)).otherwise(F.lit("")) if allowed else F.lit("")
    if kind in ("ontology_array", "string_array", "ref_array"):
        items = arrays.parse_list_loose(c)
        return arrays.csv_join(arrays.allowed_only(items, allowed) if allowed else arrays.dedupe_ci(items))
    return _clean(c)


def normalize_table(df: DataFrame, types: dict[str, str], allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """N13, M15 (first pass): every known column coerced, unknown ones untouched."""
    allowed = allowed or {}
    return df.select(*[coerce(types[c], F.col(f"`{c}`"), allowed.get(c)).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])
