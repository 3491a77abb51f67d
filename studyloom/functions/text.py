"""Text scalars as Column expressions (T2-T8, T10-T15, T17-T26). Null text counts as empty."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from studyloom.functions.arrays import dedupe_ci
from studyloom.session import strip

MIN_CHARS, MIN_ALNUM = 3000, 0.35


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def alnum_count(c: Column) -> Column:
    return F.length(F.regexp_replace(_text(c), r"[^\p{L}\p{N}]", ""))


def alnum_ratio(c: Column) -> Column:
    """Letters and digits per character of the stripped text; 0.0 if blank."""
    n = F.length(strip(_text(c)))
    return F.when(n > 0, alnum_count(c) / n).otherwise(F.lit(0.0))


def quality_score(c: Column) -> Column:
    """Letters and digits, plus 10 per Latin word of two letters, plus 2 per distinct such word up to 2000."""
    words = F.regexp_extract_all(_text(c), F.lit(r"([A-Za-z]{2,})"), F.lit(1))
    distinct = F.size(F.array_distinct(F.transform(words, F.lower)))
    return (alnum_count(c) + 10 * F.size(words) + 2 * F.least(distinct, F.lit(2000))).cast("long")


def needs_fallback(c: Column) -> Column:
    """T4: too short or too few letters and digits."""
    return (F.length(strip(_text(c))) < MIN_CHARS) | (alnum_ratio(c) < MIN_ALNUM)


def better_text(current: Column, candidate: Column) -> Column:
    """T5: the candidate if it is not blank and scores strictly higher."""
    return F.when((strip(_text(candidate)) != "") & (quality_score(candidate) > quality_score(current)), candidate).otherwise(current)


def safe_stem(path: Column) -> Column:
    """File name without extension, other characters than [A-Za-z0-9._-] as one "_", "paper" if nothing is left."""
    name = F.regexp_replace(F.regexp_replace(_text(path), r"/+$", ""), r"^.*/", "")
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    clean = F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(clean == "", F.lit("paper")).otherwise(clean)


def normalize_ws(c: Column) -> Column:
    """No soft hyphens, one kind of dash, single spaces, trimmed."""
    t = F.regexp_replace(_text(c), "­", "")
    t = F.regexp_replace(t, "[‐‑‒–—]", "-")
    return F.trim(F.regexp_replace(t, r"[\s\x1c-\x1f\x{85}\p{Z}]+", " "))


# Fixed value: the form of a DOI.
DOI = r"\b(10\.\d{4,9}/[-._;()/:A-Za-z0-9]+)\b"


def first_doi(c: Column) -> Column:
    """First DOI without trailing punctuation; null if none."""
    hit = F.regexp_extract(_text(c), DOI, 1)
    return F.when(hit != "", F.regexp_replace(hit, r"[.,;:)]+$", ""))


def identifier(c: Column) -> Column:
    """DOI of a DOI URL or "doi:" form, else the value as it stands, trimmed."""
    raw = strip(_text(c))
    bare = F.regexp_replace(F.regexp_replace(raw, r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", ""), r"[.,;:)]+$", "")
    return F.when(bare.rlike(r"^10\.\d{4,9}/[-._;()/:A-Za-z0-9]+$"), bare).otherwise(raw)


# The phrase that names a number of participants.
PARTICIPANTS = r"(?i)\b(?:about|approximately|approx\.?|circa|around|at least)?\s*(\d{2,6})\s*(?:patients|participants)\s*(?:will be included|included)\b"


def participant_hint(c: Column) -> Column:
    """The number in the first phrase of the kind, of text with normalised white space; null if none."""
    n = F.regexp_extract(normalize_ws(c), PARTICIPANTS, 1)
    return F.when(n != "", n.cast("long"))


# The phrase that names a data set, and the words cut from its beginning.
DATASET = r"(?i)\b([A-Za-z0-9][A-Za-z0-9'()/\- ]{0,60}\bdataset)\b"
DATASET_STOP = r"(?i)^(?:(?:and|or|the|a|an|of|for|in)(?: |$))+"


def dataset_hints(c: Column, limit: int = 3) -> Column:
    """Up to limit phrases, distinct without case, that end in "dataset": of at least 8 characters, their last six
    words without leading stop words."""
    phrases = F.transform(F.regexp_extract_all(normalize_ws(c), F.lit(DATASET), F.lit(1)), normalize_ws)
    long = F.filter(phrases, lambda p: F.length(p) >= 8)
    last = F.transform(long, lambda p: F.array_join(F.slice(F.split(p, " "), -F.least(F.size(F.split(p, " ")), F.lit(6)), 6), " "))
    clean = F.transform(last, lambda p: F.regexp_replace(p, DATASET_STOP, ""))
    return F.slice(dedupe_ci(F.filter(clean, lambda p: ~F.lower(p).isin("dataset", "data set"))), 1, limit)


# Patterns for sample sets, and sample types in order.
SAMPLE_NAMES = (r"\bbiological samples?\b", r"\bbiomaterials?\b", r"\bbiobank samples?\b", r"\bdata-biobank\b")
SAMPLE_TYPES = ("Bone marrow", "Whole blood", "Blood", "Serum", "Plasma", "Urine", "Saliva", "Tissue", "Feces", "Stool", "DNA", "RNA")


def sampleset_name(c: Column) -> Column:
    """First of the ordered patterns that occurs; null if none."""
    return F.coalesce(*[F.nullif(F.regexp_extract(_text(c), f"(?i)({p})", 1), F.lit("")) for p in SAMPLE_NAMES])


def sample_types(c: Column) -> Column:
    """Sample types named in the text, in fixed order."""
    return F.array_compact(F.array(*[F.when(_text(c).rlike(rf"(?i)\b{t.lower()}\b"), F.lit(t)) for t in SAMPLE_TYPES]))


def norm_key(c: Column) -> Column:
    """Lower case letters a-z and digits only."""
    return F.regexp_replace(F.lower(_text(c)), r"[^a-z0-9]+", "")


def snake_case(c: Column) -> Column:
    """Lower case words joined by "_"."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(_text(c))), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def display_name(*parts: Column) -> Column:
    """Non-blank parts joined by a space."""
    return F.concat_ws(" ", *[F.nullif(strip(p), F.lit("")) for p in parts])


# Resource types and the patterns that tell them, in order.
RESOURCE_TYPES = {
    "Biobank": r"\bbiobank\b|\bdata[-\s]?biobank\b", "Clinical trial": r"\bclinical trial\b|\brandomi[sz]ed trial\b|\btrial\b", "Cohort study": r"\bcohort\b",
    "Registry": r"\bregistr(?:y|ies)\b", "Health records": r"\bhealth records?\b|\bmedical records?\b|\belectronic health records?\b|\behr\b", "Network": r"\bnetwork\b",
    "Catalogue": r"\bcatalog(?:ue)?\b", "Preclinical study": r"\bpreclinical\b", "Common data model": r"\bcommon data model\b|\bcdm\b", "Reference data source": r"\breference data\b",
}
CANONICAL_TYPES = (*RESOURCE_TYPES, "Other type")


def resource_types(types: Column, haystack: Column) -> Column:
    """Known labels among types, else what the text tells, else "Other type"."""
    known = F.create_map(*[F.lit(x) for t in CANONICAL_TYPES for x in (re.sub("[^a-z0-9]", "", t.lower()), t)], F.lit("catalog"), F.lit("Catalogue"))
    own = F.array_distinct(F.array_compact(F.transform(types, lambda t: F.try_element_at(known, norm_key(t)))))
    told = F.array_compact(F.array(*[F.when(F.lower(_text(haystack)).rlike(p), F.lit(t)) for t, p in RESOURCE_TYPES.items()]))
    return F.when(F.size(own) > 0, own).when(F.size(told) > 0, told).otherwise(F.array(F.lit("Other type")))


def event_name(c: Column) -> Column:
    """Time points as "m<months>"; other names cleaned."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(strip(_text(c))), r"[-_/]", " "), r"\s+", " "))
    months = F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r"\b(\d+)\s*(?:month|months|mo)\b", r"\bmonth\s*(\d+)\b")])
    years = F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r"\byear\s*(\d+)\b", r"\b(\d+)\s*year\b")])
    return (
        F.when(t.isin("baseline", "enrolment", "enrollment", "t0", "time 0"), F.lit("m0"))
        .when(months.isNotNull(), F.concat(F.lit("m"), months.cast("long").cast("string")))
        .when(years.isNotNull(), F.concat(F.lit("m"), (years.cast("long") * 12).cast("string")))
        .otherwise(t)
    )


# Fixed value: words that tell an outcome, not a source.
OUTCOMES = r"(?i)\b(survival|mortality|outcome|response|recurrence)\b"


def drop_tokens(c: Column, pattern: str) -> Column:
    """Split at ";" and ",", drop tokens that match, distinct without case, joined by "; "."""
    toks = F.filter(F.transform(F.split(_text(c), "[;,]"), strip), lambda x: (x != "") & ~x.rlike(pattern))
    return F.array_join(dedupe_ci(toks), "; ")


# The phrase that tells restricted access, and the words that tell of a fee.
ON_REQUEST = r"available (?:upon|on) request|upon reasonable request|made available on request"
FEE = r"(?i)\b(fee|cost|charge|payment|paid|pricing|subscription)\b"


def sentence_with(c: Column, pattern: str = ON_REQUEST, most: int = 400) -> Column:
    """The sentence of the first match, white space normalised, at most so many characters (a bound of the feature); null if none."""
    hit = normalize_ws(F.regexp_extract(normalize_ws(c), rf"(?i)([^.]*(?:{pattern})[^.]*\.)", 1))
    return F.when(hit != "", hit.substr(1, most))


def access_rights(rights: Column, c: Column) -> Column:
    """T24: "Restricted access" where no rights are given and the text tells access on request."""
    return F.when((strip(_text(rights)) == "") & normalize_ws(c).rlike(f"(?i){ON_REQUEST}"), F.lit("Restricted access")).otherwise(rights)


def access_fee(fee: Column, c: Column) -> Column:
    """Null where a fee is claimed but no word of the text tells of one."""
    claimed = F.lower(strip(_text(fee.cast("string")))).isin("1", "true", "yes", "on")
    return F.when(claimed & ~normalize_ws(c).rlike(FEE), F.lit(None)).otherwise(fee)


def strip_fences(c: Column) -> Column:
    """Without code fences, byte order marks and replacement characters."""
    t = F.regexp_replace(F.regexp_replace(_text(c), "﻿", ""), "[ �]", " ")
    return strip(F.regexp_replace(F.regexp_replace(strip(t), r"^```[A-Za-z0-9]*\s*", ""), r"\s*```$", ""))


def pick_allowed(allowed: Column, *needles: str) -> Column:
    """First allowed label whose key contains one of the needles."""
    hit = F.filter(allowed, lambda a: F.array_contains(F.array(*[F.contains(norm_key(a), F.lit(n)) for n in needles]), True))
    return F.try_element_at(hit, F.lit(1))


@F.pandas_udf(StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """Compatibility form without combining marks."""
    return s.map(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)) if isinstance(x, str) else None)


# Fixed value: marks that separate words of a place name.
GEO_MARKS = r"[()\[\]*'’`\".,;/_-]+"


def geo_key(c: Column, country: bool = True) -> Column:
    """Accents dropped, lower case, "&" as "and", "(the)" dropped for countries, marks as spaces, single spaces."""
    t = F.replace(strip(F.lower(strip_accents(_text(c)))), F.lit("&"), F.lit(" and "))
    if country:
        t = F.replace(t, F.lit("(the)"), F.lit(""))
    return strip(F.regexp_replace(F.regexp_replace(t, GEO_MARKS, " "), r"[\s\p{Z}]+", " "))


# Fixed value: a line that heads a reference list.
_REF_HEAD = re.compile(r"(?im)^\s*(?:\d{1,2}(?:\.\d+)?\s*)?(?:references?|bibliography|works\s+cited|literature\s+cited|reference\s+list)\s*:?\s*$")


# Signs of a reference list, and how often each must occur.
_REF_SIGNS = (
    (re.compile(r"\[\d{1,3}\]"), 3), (re.compile(r"\(\d{4}[a-z]?\)", re.I), 3), (re.compile(r"\b10\.\d{4,9}/\S+", re.I), 1),
    (re.compile(r"\b(?:doi|vol\.?|pp\.?|et al\.)\b", re.I), 4), (re.compile(r"\b\d{4}\b"), 12),
)


def looks_like_references(tail: str) -> bool:
    """At least 600 characters, and at least two of the five signs of a reference list."""
    return len(tail) >= 600 and sum(sum(1 for _ in sign.finditer(tail)) >= k for sign, k in _REF_SIGNS) >= 2


@F.pandas_udf(StringType())
def strip_references(s: pd.Series) -> pd.Series:
    """Text up to the first heading past 35 % behind which a reference list stands, unless too little would be left."""

    def one(t):
        if not isinstance(t, str):
            return None
        for m in _REF_HEAD.finditer(t):
            if m.start() >= int(0.35 * len(t)) and looks_like_references(t[m.start() :]):
                kept = t[: m.start()].rstrip()
                return kept if len(kept) >= max(1000, int(0.2 * len(t))) else t
        return t

    return s.map(one)
