"""Repairs of records from their own evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studyloom.operators import relational as R


def _low(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def contact_from_people(first: Column, last: Column, email: Column, people: Column) -> Column:
    """struct(first_name, last_name, email): if the first name has at most one letter, the first person of the list with
    a longer one whose e-mail or last name is the contact's; what is blank is filled, what is there stays."""
    same = lambda a, b: (_low(a) != "") & (_low(a) == _low(b))
    hit = F.try_element_at(
        F.filter(people, lambda p: (F.length(F.trim(F.coalesce(p["first_name"], F.lit("")))) > 1) & (same(p["email"], email) | same(p["last_name"], last))), F.lit(1)
    )
    short = F.length(F.trim(F.coalesce(first, F.lit("")))) <= 1
    fill = lambda own, other: F.when(short & (_low(own) == ""), other).otherwise(own)
    return F.struct(
        F.when(short, F.coalesce(hit["first_name"], first)).otherwise(first).alias("first_name"), fill(last, hit["last_name"]).alias("last_name"), fill(email, hit["email"]).alias("email")
    )


def adult_age(age_min: Column, groups: Column) -> Column:
    """Null where only adults are included but the least age is below 18."""
    adult = F.exists(groups, lambda g: _low(g).startswith("adult"))
    return F.when(adult & (age_min < 18), F.lit(None)).otherwise(age_min)


def resolve_array(df: DataFrame, key: str, items: str, stages: list) -> DataFrame:
    """(key, items): every item resolved, unmapped ones dropped, first of each kept in order; keys without items stay."""
    long = df.select(key, F.posexplode(items).alias("pos", "raw"))
    done = R.resolve(long, "raw", stages).filter("canonical IS NOT NULL").groupBy(key, "canonical").agg(F.min("pos").alias("pos"))
    lists = done.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "canonical"))), lambda s: s["canonical"]).alias(items))
    return df.select(key).join(lists, key, "left").withColumn(items, F.coalesce(items, F.array().cast("array<string>")))
