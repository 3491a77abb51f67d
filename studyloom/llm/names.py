"""Variant spellings of names typed by people (problem 2).

Method: noisy-channel attribution. Distinct writings are counted first, so that repeats cost nothing. A name is taken apart
into its proper words and the rest (kind of body, given name, titles, particles). For a word of a body that is not a whole
listed word, the posterior combines how often each listed word, or run of words, stands in the data with the chance that a
writer shortens it to this (cut off, letters dropped, initials) or misspells it, against the chance of a proper word.
Frequent spellings of a proper word are the candidate canonical forms; for a variant v and a candidate c within two edits, the
posterior combines the frequency prior with the chance that writers of c would produce exactly this typo in the share
n(v) / n(c), at typo rates of the data, against the chance that v is a name of its own. Each variant is attached to its
maximum posterior; chains of typos are followed to their end. Candidates come from shared deletions of one or two letters,
which loses no pair within so many edits. Familiar forms of given names come from a fixed table. An initial is attached to the
given name of the family that has the maximum posterior: as every name gives its initial alike, the most frequent one.

Defined results: blank names, names of a unit only, and persons without a given or a family name get no entity; equal
frequencies go to the alphabetically first; repeated rows share their entity (rows without a row_id of their own are not told apart); empty tables give empty results; names of any
length are compared whole. Only the columns named are read, so clashing names cannot matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, log1p

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.llm.nameparts import FAMILIAR, LETTER, Channel, evidence_of, person_tokens
from studyloom.llm.placenames import within
from studyloom.operators.skew import by_sort, join_hot, self_pairs
from studyloom.session import blank, cut, strip

TYPO = 0.15  # chance that a written name has a typo, as far as the data do not tell
PRIOR = 20  # names that this chance counts as, against those of the data
SHAPE = 0.1  # of the gamma distribution of a typo's rate: some typos are far more usual than others
RARE = 10  # a word so many times rarer than a neighbour counts as its typo when the chance is estimated
AGAIN = 0.3  # chance of a second typo in a misspelt name
TWICE = 7  # two typos in a shorter word are never likelier than a word of its own
BLOCK = 2000  # rows of a writing, and writings of an entity, that are paired at once


def log_odds(n_c: float, n_v: float, length: int, typo: float = TYPO, edits: int = 1) -> float:
    """Log of the posterior odds that v (n_v times) is a typo of c (n_c times) rather than a name of its own.

    A typo is counted by a negative binomial, so that the share n_v / n_c decides at any size; a typo rarer than expected
    scores as one at its expected share. The count of a name of its own is log-uniform up to n_c.
    """
    ways = 30.0 * length if edits == 1 else (30.0 * length) ** 2 / 2
    typo = typo if edits == 1 else typo * AGAIN
    n_c = min(n_c, n_v * ways / typo)
    rate = n_c * typo / ways
    seen = lgamma(n_v + SHAPE) - lgamma(SHAPE) - lgamma(n_v + 1) + n_v * log(rate / (rate + SHAPE)) + SHAPE * log(SHAPE / (rate + SHAPE))
    own = log(ways) - LETTER * length - log(n_v) - log1p(log(max(n_c, 1)))
    return seen - own


def evidence(n_c: int, n_v: int, d_c: int, d_v: int) -> tuple[float, float]:
    """Counts of c and v in the share of their rows, scaled to their distinct writings: copies of rows are no evidence."""
    part = min(1.0, (d_c + d_v) / (n_c + n_v))
    n_v = n_v * part
    return n_c * part / min(n_v, 1), max(n_v, 1.0)


_ONE = "transform(sequence(1, length(word)), i -> concat(substring(word, 1, i - 1), substring(word, i + 1)))"
_TWO = ("flatten(transform(sequence(1, length(word) - 1), i -> transform(sequence(i + 1, length(word)), j -> "
        "concat(substring(word, 1, i - 1), substring(word, i + 1, j - i - 1), substring(word, j + 1)))))")


def attach_variants(words: DataFrame, own: frozenset[str] = frozenset()) -> DataFrame:
    """(space, word, canon, odds) of words (space, word, n, and d, the distinct writings, else n): each word with its canonical form.
    Words of ``own`` are known as names of their own and are no typos."""
    if "d" not in words.columns:
        words = words.withColumn("d", F.col("n"))
    long = words.filter(F.length("word") >= 2)
    deletes = F.array_distinct(F.concat(F.array("word"), F.expr(_ONE), F.when(F.length("word") >= TWICE, F.expr(_TWO)).otherwise(F.array().cast("array<string>"))))
    keyed = long.select("space", "word", "n", "d", F.explode(deletes).alias("key"))
    v = keyed.withColumnRenamed("word", "v").withColumnRenamed("n", "n_v").withColumnRenamed("d", "d_v")
    c = keyed.withColumnRenamed("word", "c").withColumnRenamed("n", "n_c").withColumnRenamed("d", "d_c")
    # Words that share a deletion differ in one or two places of it: an alphabet's worth of words at most, not a group of rows.
    pairs = v.filter(~F.col("v").isin(*own)) if own else v
    pairs = pairs.join(by_sort(c), ["space", "key"]).filter("n_c > n_v OR (n_c = n_v AND c < v)").select("space", "v", "c", "n_v", "n_c", "d_v", "d_c").distinct()

    @F.pandas_udf("int")
    def distance(v: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([within(a, b, 2) for a, b in zip(v, c)], dtype="int32")

    @F.pandas_udf("double")
    def posterior(v: pd.Series, c: pd.Series, n_v: pd.Series, n_c: pd.Series, d_v: pd.Series, d_c: pd.Series, typo: pd.Series, edits: pd.Series) -> pd.Series:
        return pd.Series([
            log_odds(*evidence(*n), max(len(a), len(b)), t, e) for a, b, t, e, *n in zip(v, c, typo, edits, n_c, n_v, d_c, d_v)
        ], dtype="float64")

    pairs = cut(pairs.withColumn("edits", distance("v", "c")).filter(f"edits = 1 OR (edits = 2 AND length(v) >= {TWICE} AND length(c) >= {TWICE})"))
    # The chance of a typo in each space, one row a space: the mean over its names, so that a hot one counts as one.
    share = F.sum("n_v") / (F.sum("n_v") + F.first("n_c"))
    wrong = pairs.filter(F.col("n_c") >= RARE * F.col("n_v")).filter("edits = 1").groupBy("space", F.col("c").alias("word")).agg(share.alias("share"))
    typo = (F.coalesce(F.sum("share"), F.lit(0)) + TYPO * PRIOR) / (F.count(F.lit(1)) + PRIOR)
    chance = long.filter(F.col("n") >= RARE).join(by_sort(wrong), ["space", "word"], "left").groupBy("space").agg(typo.alias("typo"))
    scored = pairs.join(F.broadcast(chance), "space", "left").fillna(TYPO, ["typo"]).withColumn("odds", posterior("v", "c", "n_v", "n_c", "d_v", "d_c", "typo", "edits")).filter("odds > 0")
    best = scored.groupBy("space", "v").agg(F.min(F.struct((-F.col("odds")).alias("o"), (-F.col("n_c")).alias("m"), "c")).alias("b"))
    out = cut(best.select("space", F.col("v").alias("word"), F.col("b.c").alias("canon"), (-F.col("b.o")).alias("odds")))
    while True:  # a typo of a typo: counts grow along a chain, so it ends; paths double at every step
        up = out.select("space", F.col("word").alias("canon"), F.col("canon").alias("up"))
        further = out.join(by_sort(up), ["space", "canon"])
        if further.isEmpty():
            break
        out = cut(out.join(by_sort(up), ["space", "canon"], "left").select("space", "word", F.coalesce("up", "canon").alias("canon"), "odds"))
    return words.select("space", "word").distinct().join(by_sort(out), ["space", "word"], "left").select(
        "space", "word", F.coalesce("canon", "word").alias("canon"), "odds"
    )


def organisation_writings(organisations: DataFrame) -> DataFrame:
    """(row_id, w): organisation, or name if that has no value, trimmed."""
    w = strip(F.when(~blank(F.col("organisation")), F.col("organisation")).when(~blank(F.col("name")), F.col("name")))
    return organisations.select("row_id", w.alias("w")).filter("w IS NOT NULL")


def organisation_entities(organisations: DataFrame) -> DataFrame:
    """(kind, row_id, writing, entity)."""
    rows = organisation_writings(organisations)
    counts = cut(rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")))

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([e for w in b["w"] for e in evidence_of(w)], columns=["key", "kinds"], dtype=object)

    told = cut(counts.select("w").mapInPandas(tell, "key string, kinds string").groupBy("key", "kinds").agg(F.count(F.lit(1)).alias("n")))
    # At most one row a listed word, and one a text of two to four initials (the commonest kind of body of each).
    listed = {r["key"]: float(r["n"]) for r in told.filter("kinds = ''").collect()}
    top = told.filter("kinds <> '' AND key RLIKE '^[a-z]{2,4}$'").groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("m"), "kinds")).alias("t"))
    initials = {r["key"]: (r["t"]["kinds"], float(-r["t"]["m"])) for r in top.collect()}
    n_writings = float(counts.count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        channel = Channel(listed, initials, n_writings)
        for b in batches:
            parts = [channel.body_parts(w) for w in b["w"]]
            yield pd.DataFrame([(w, n, *p) for w, n, p in zip(b["w"], b["n"], parts)], columns=["w", "n", "word", "body"], dtype=object)

    parsed = cut(counts.mapInPandas(run, "w string, n long, word string, body string").filter("word <> ''"))
    words = parsed.groupBy(F.lit("o").alias("space"), "word").agg(F.sum("n").alias("n"), F.countDistinct("w").alias("d"))
    canon = attach_variants(words).select("word", "canon")
    entity = parsed.join(by_sort(canon), "word").select("w", F.concat_ws("|", "canon", "body").alias("entity"))
    joined = join_hot(rows, by_sort(entity), ["w"], counts).filter("entity IS NOT NULL")
    return joined.select(F.lit("organisation").alias("kind"), "row_id", F.col("w").alias("writing"), "entity")


def contact_writings(contacts: DataFrame) -> DataFrame:
    """(row_id, f, l): first and last name, trimmed, null if blank."""
    side = {k: strip(F.when(~blank(F.col(c)), F.col(c))) for k, c in (("f", "first_name"), ("l", "last_name"))}
    rows = contacts.select("row_id", side["f"].alias("f"), side["l"].alias("l")).filter("f IS NOT NULL OR l IS NOT NULL")
    return rows.withColumn("w", F.concat(F.coalesce("f", F.lit("")), F.lit("\u0001"), F.coalesce("l", F.lit(""))))


def contact_entities(contacts: DataFrame) -> DataFrame:
    """(kind, row_id, writing, entity)."""
    rows = contact_writings(contacts).select("row_id", "w")
    counts = cut(rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for w, n in zip(b["w"], b["n"]):
                given, family = person_tokens(*w.split("\u0001"))
                if given and family:
                    # Sides 0 and 1: typed as given and as family name; one word each side, or the parts of a double name.
                    out.append((w, n, 0, [p for p in given[0].split("-") if p] or [given[0]]))
                    out.append((w, n, 1, family[-1] or [""]))
            yield pd.DataFrame(out, columns=["w", "n", "side", "parts"], dtype=object)

    sides = cut(counts.mapInPandas(run, "w string, n long, side int, parts array<string>"))
    tokens = sides.select("w", "n", "side", F.posexplode("parts").alias("pos", "word"))
    words = tokens.groupBy(F.lit("p").alias("space"), "word").agg(F.sum("n").alias("n"), F.countDistinct("w").alias("d"))
    familiar = F.create_map(*[F.lit(x) for kv in FAMILIAR.items() for x in kv])
    canon = attach_variants(words, frozenset(FAMILIAR)).select("word", F.col("canon").alias("c0"))
    named = tokens.join(by_sort(canon), "word").withColumn("canon", F.coalesce(F.try_element_at(familiar, F.col("c0")), "c0"))
    # How often a canonical word stands on either side tells given from family names, also in swapped fields.
    roles = named.filter(F.length("canon") > 1).groupBy("canon").agg(
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("as_given"),
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("as_family"),
    )
    known = named.join(by_sort(roles), "canon", "left").fillna(0, ["as_given", "as_family"])
    part = known.groupBy("w", "n", "side").agg(
        F.max(F.struct("as_family", (-F.col("pos")).alias("p"), "canon", "as_given")).alias("fam"), F.min(F.struct("pos", "canon")).alias("first")
    )
    both = part.groupBy("w", "n").agg(
        *[F.max(F.when(F.col("side") == s, F.struct(F.col("fam.canon").alias("canon"), "fam.as_family", "fam.as_given", F.col("first.canon").alias("first")))).alias(f"s{s}") for s in (0, 1)]
    ).filter("s0 IS NOT NULL AND s1 IS NOT NULL")
    swapped = (
        ((F.col("s0.as_family") > F.col("s0.as_given")) | (F.length("s0.canon") > 1) & (F.col("s0.as_family") == F.col("s0.as_given")))
        & ((F.col("s1.as_given") > F.col("s1.as_family")) | (F.length("s1.canon") == 1))
    )
    people = cut(both.select(
        "w", "n", F.when(swapped, F.col("s0.canon")).otherwise(F.col("s1.canon")).alias("family"),
        F.when(swapped, F.col("s1.first")).otherwise(F.col("s0.first")).alias("given"),
    ))
    full = people.filter(F.length("given") > 1).groupBy("family", "given").agg(F.sum("n").alias("n"))
    top = full.groupBy("family", F.substring("given", 1, 1).alias("initial")).agg(F.min(F.struct((-F.col("n")).alias("m"), "given")).alias("t"))
    who = people.withColumn("initial", F.substring("given", 1, 1)).join(by_sort(top), ["family", "initial"], "left")
    given = F.when(F.length("given") > 1, F.col("given")).otherwise(F.coalesce("t.given", "given"))
    entity = who.select("w", F.concat_ws("|", "family", given).alias("entity"))
    joined = join_hot(rows, by_sort(entity), ["w"], counts).filter("entity IS NOT NULL")
    return joined.select(F.lit("contact").alias("kind"), "row_id", F.col("w").alias("writing"), "entity")


def entities(organisations: DataFrame, contacts: DataFrame) -> DataFrame:
    """(kind, row_id, writing, entity, n_rows): one row per record that names an entity."""
    e = organisation_entities(organisations).unionByName(contact_entities(contacts))
    size = e.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n_rows"))
    return e.join(by_sort(size), ["kind", "entity"]).select("kind", "row_id", F.regexp_replace("writing", "\u0001", " ").alias("writing"), "entity", "n_rows")


def linked_pairs(organisations: DataFrame, contacts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(kind, row_a, row_b): rows of one entity in different writing, row_a < row_b.

    Pairs are formed between the distinct writings of an entity; the rows of a writing are joined on in blocks. Rows in equal
    writing are never paired, and no task holds all rows of a writing.
    """
    e = cut(organisation_entities(organisations).unionByName(contact_entities(contacts)))
    written = cut(e.groupBy("kind", "entity", "writing").agg(F.count(F.lit(1)).alias("n")))
    written = written.withColumn("blocks", F.ceil(F.col("n") / block).cast("long"))
    pairs = self_pairs(written, ["kind", "entity"], "writing", ["blocks"], block)
    for side in ("a", "b"):
        pairs = pairs.withColumn(f"block_{side}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"blocks_{side}") - 1)))
    rows = join_hot(e.select("kind", "writing", "row_id"), by_sort(written.select("kind", "writing", "blocks")), ["kind", "writing"], written)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("blocks"))).drop("blocks")
    for side in ("a", "b"):
        own = rows.select("kind", *[F.col(c).alias(f"{c}_{side}") for c in ("writing", "block", "row_id")])
        pairs = pairs.join(by_sort(own), ["kind", f"writing_{side}", f"block_{side}"])
    return pairs.select("kind", F.least("row_id_a", "row_id_b").alias("row_a"), F.greatest("row_id_a", "row_id_b").alias("row_b"))
