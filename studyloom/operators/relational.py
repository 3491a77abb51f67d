"""Relational shapes of the pipeline: joins, indexes, merges, windows, set operations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from studyloom.functions.arrays import dedupe_ci
from studyloom.operators.skew import numbered
from studyloom.session import blank, cut, parallelism, strip


def drop_parents_with_children(parents: DataFrame, children: DataFrame, pid: str, cid: str) -> DataFrame:
    """Parents whose id no child has; parents with a blank id stay."""
    ids = children.select(strip(F.col(cid).cast("string")).alias("__id")).filter("__id <> ''").distinct()
    return parents.join(ids, strip(parents[pid].cast("string")) == ids["__id"], "left_anti")


def full_merge(core: DataFrame, extra: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer join on a key; values of extra win where they are not null, lists are joined without repeats."""
    c, e = core.alias("c"), extra.alias("e")
    kinds = dict(core.dtypes)

    def one(v: str) -> Column:
        if kinds[v].startswith("array"):
            none = F.array().cast(kinds[v])
            return dedupe_ci(F.concat(F.coalesce(F.col(f"c.{v}"), none), F.coalesce(F.col(f"e.{v}"), none))).alias(v)
        return F.coalesce(F.col(f"e.{v}"), F.col(f"c.{v}")).alias(v)

    return c.join(e, F.col(f"c.{key}") == F.col(f"e.{key}"), "full_outer").select(F.coalesce(f"c.{key}", f"e.{key}").alias(key), *[one(v) for v in values])


def best_match(seeds: DataFrame, details: DataFrame, seed: str, equal: list[tuple[str, str]], pos: str) -> DataFrame:
    """The detail of each seed by the first equality that holds (each an equi-join), then by position in details."""
    hits = None
    for prio, (a, b) in enumerate(equal):
        keyed = details.select(F.col(b).alias("__k"), F.col(pos).alias("__pos")).filter("__k IS NOT NULL")
        keyed = keyed.groupBy("__k").agg(F.min("__pos").alias("__pos"))  # the first detail of a key, before the join
        h = seeds.select(seed, F.col(a).alias("__k")).join(keyed, "__k").select(seed, F.struct(F.lit(prio).alias("prio"), F.col("__pos").alias("pos")).alias("m"))
        hits = h if hits is None else hits.unionAll(h)
    best = hits.groupBy(seed).agg(F.min("m").alias("m")).select(seed, "m.prio", F.col("m.pos").alias(pos))
    return seeds.select(seed).join(best, seed, "left")


def first_wins_index(df: DataFrame, row: str, value: str, tokens: list[str], key) -> DataFrame:
    """Key of each token to the value of the first row (then first token column) that has it."""
    t = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), key(F.col(c)).alias("k")) for i, c in enumerate(tokens)]))
    long = df.select(F.col(row).alias("r"), F.col(value).alias("v"), t.alias("t")).select("r", "v", "t.i", "t.k").filter("k <> ''")
    return long.groupBy("k").agg(F.min_by("v", F.struct("r", "i")).alias("canonical"))


def unambiguous_index(df: DataFrame, canonical: str, tokens: list[str], key) -> DataFrame:
    """Token keys that belong to exactly one canonical value."""
    long = df.select(F.col(canonical).alias("c"), F.explode(F.array(*[key(F.col(x)) for x in tokens])).alias("k")).filter("k <> '' AND c IS NOT NULL")
    return long.distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("canonical")).filter("n = 1").drop("n")


def resolve(df: DataFrame, raw: str, stages: list[tuple[str, DataFrame, object]], into: str = "canonical") -> DataFrame:
    """Canonical value and method by the first index (k, canonical) that knows the raw value's key."""
    out = df
    found, how = [], []
    for i, (name, index, key) in enumerate(stages):
        ix = index.select(F.col("k").alias(f"__k{i}"), F.col("canonical").alias(f"__c{i}"))
        out = out.join(ix, key(F.col(raw)) == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__c{i}"))
        how.append(F.when(F.col(f"__c{i}").isNotNull(), F.lit(name)))
    keep = [F.col(f"`{c}`") for c in df.columns]
    return out.select(*keep, F.coalesce(*found).alias(into), F.coalesce(*how, F.lit("unmapped")).alias("method"))


def longest_prefix(df: DataFrame, col: str, prefixes: DataFrame, prefix: str, value: str) -> DataFrame:
    """Value of the longest prefix of a text: all prefixes of the text as keys of an equi-join, no theta join."""
    keys = F.transform(F.sequence(F.lit(0), F.length(col)), lambda i: F.substring(F.col(col), F.lit(1), i))
    ids = df.select(col).distinct()
    hit = ids.withColumn("__p", F.explode(keys)).join(prefixes.select(F.col(prefix).alias("__p"), F.col(value).alias("__v")), "__p")
    best = hit.groupBy(col).agg(F.max_by("__v", F.length("__p")).alias(value))
    return df.join(best, col, "left")


def last_non_null(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Ordered merge in which null never overwrites: the last non-null value of each column."""
    return df.groupBy(*keys).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values])


def merged_list(df: DataFrame, keys: list[str], order: str, values: str) -> DataFrame:
    """Lists joined in order without repeats (without case). Repeats go before anything is collected, so what meets in one
    task is what stands in the result."""
    long = df.select(*keys, F.col(order).alias("__o"), F.posexplode(values).alias("__p", "__x")).filter("trim(__x) <> ''")
    first = long.groupBy(*keys, F.lower(F.trim("__x")).alias("__k")).agg(F.min(F.struct("__o", "__p", "__x")).alias("__m"))
    lists = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("__m")), lambda m: m["__x"]).alias(values))
    none = F.array().cast(dict(df.dtypes)[values])
    return df.select(*keys).distinct().join(lists, keys, "left").withColumn(values, F.coalesce(values, none))


def first_by_identity(df: DataFrame, key: Column, order: str) -> DataFrame:
    """First row of each non-blank key (combined before the shuffle, so a hot key is no burden); rows without key stay."""
    keyed = df.withColumn("__key", F.coalesce(key, F.lit("")))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    first = keyed.filter("__key <> ''").groupBy("__key").agg(F.min_by(row, order).alias("__row")).select("__row.*")
    return first.unionByName(keyed.filter("__key = ''").drop("__key"))


def dense_index(df: DataFrame, keys: list[str], order: str, keep: Column, into: str = "idx") -> DataFrame:
    """Rows that hold something, numbered from 1 within their parent."""
    return numbered(df.filter(keep), keys, order, into)


def global_index(df: DataFrame, order: str, into: str = "idx") -> DataFrame:
    """Rows numbered from 1 over the whole table: ranges of the order, their sizes summed up, numbers within each range."""
    ranged = cut(df.repartitionByRange(parallelism(df.sparkSession), order).withColumn("__part", F.spark_partition_id()))
    before, n = [], 0
    for r in ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect():  # one row a range
        before.append((r["__part"], n))
        n += r["n"]
    offsets = F.broadcast(df.sparkSession.createDataFrame(before, "__part int, __before long"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return ranged.withColumn("__own", own).join(offsets, "__part").withColumn(into, F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")


def slug(c: Column) -> Column:
    """Lower case words joined by "-", at most 80 characters (a bound of the feature)."""
    t = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9]+", "-"), r"^-+|-+$", "").substr(1, 80)


_NUMBER = r"(-\d+)+$"


def _deal(rows: Iterator[tuple]) -> Iterator[str]:
    """Ids of rows (family, id, slug), ids of their own first in each family; the state is one number for each slug of a family."""
    family, used, nxt = None, set(), {}

    def taken(form: str) -> bool:
        if form in used:
            return True
        stem, dash, number = form.rpartition("-")
        # Every number below the next one of a stem is used, by the stem's own rows or by others.
        return bool(dash) and number.isdecimal() and number[0] != "0" and 2 <= int(number) < nxt.get(stem, 0)

    for fam, own, base in rows:
        if fam != family:
            family, used, nxt = fam, set(), {}
        if own:
            used.add(own)
            yield own
        elif not taken(base):
            used.add(base)
            yield base
        else:
            k = nxt.get(base, 2)
            while taken(f"{base}-{k}"):
                k += 1
            nxt[base] = k + 1
            yield f"{base}-{k}"


def unique_ids(df: DataFrame, group: list[str], own: str, base: str, order: str, into: str = "uid") -> DataFrame:
    """Rows keep their own id; the others take, in order, their slug, slug-2, slug-3 ..., the first that no row of the
    group has. Forms can clash only within a family (a slug without numbers at its end). Families of one slug and no own id are
    numbered in parallel, hot ones in blocks; the others are dealt in order, with one number a slug as state."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    has = ~blank(F.col(own).cast("string"))
    r = df.select(F.struct(*cols).alias("__row"), F.to_json(F.struct(*group)).alias("__g"), F.when(has, F.trim(F.col(own).cast("string"))).alias("__own"), F.col(base).alias("__base"), F.col(order).alias("__o"))
    r = r.withColumn("__fam", F.regexp_replace(F.coalesce("__own", "__base"), _NUMBER, ""))
    plain = r.groupBy("__g", "__fam").agg((F.max(F.col("__own").isNotNull()) | (F.min("__base") != F.max("__base"))).alias("__mixed"))
    r = r.join(plain, ["__g", "__fam"])
    alone = numbered(r.filter("NOT __mixed"), ["__g", "__fam"], "__o", "__k")
    name = F.when(F.col("__k") == 1, F.col("__base")).otherwise(F.concat("__base", F.lit("-"), F.col("__k").cast("string")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                state.append(b)
                yield from zip(zip(b["__g"], b["__fam"]), b["__own"], b["__base"])

        ids: list[str] = []
        for uid in _deal(rows()):
            ids.append(uid)
            if len(ids) == len(state[0]):
                yield state.pop(0)[["__row"]].assign(uid=pd.Series(ids, dtype=object).to_numpy())
                ids = []

    kind = r.schema["__row"].dataType.simpleString()
    mixed = r.filter("__mixed").select("__row", "__g", "__fam", "__own", "__base", F.col("__own").isNull().alias("__new"), "__o")
    mixed = mixed.repartition("__g", "__fam").sortWithinPartitions("__g", "__fam", "__new", "__o").select("__row", "__g", "__fam", "__own", "__base")
    dealt = mixed.mapInPandas(run, f"__row {kind}, uid string")
    return alone.select("__row", name.alias("uid")).unionByName(dealt).select("__row.*", F.col("uid").alias(into))


def counts_by_gender(df: DataFrame, keys: list[str], gender: str, n: str, pos: str) -> DataFrame:
    """G1: one row per key with the last count of each gender; other genders count as total."""
    g = F.lower(strip(F.coalesce(F.col(gender), F.lit(""))))
    kind = F.when(g.isin("female", "women", "woman", "f"), "n_female").when(g.isin("male", "men", "man", "m"), "n_male").otherwise("n_total")
    return df.withColumn("__g", kind).groupBy(*keys).agg(
        *[F.max_by(n, F.when(F.col("__g") == k, F.col(pos))).alias(k) for k in ("n_total", "n_female", "n_male")]
    )


def age_defaults(df: DataFrame, group: list[str], age: str) -> DataFrame:
    """G2: "All ages" where no row of the group has an age group; warning where only some have."""
    w = Window.partitionBy(*group)
    none = F.min(blank(F.col(age)).cast("int")).over(w) == 1
    some = F.max(blank(F.col(age)).cast("int")).over(w) == 1
    issue = F.when(none, F.lit("info")).when(some, F.lit("warning"))
    return df.withColumn("__a", F.when(none, F.lit("All ages")).otherwise(F.coalesce(F.col(age), F.lit("")))).withColumn("issue", issue).withColumn(age, F.col("__a")).drop("__a")


def keyed_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Added, removed and changed keys between two keyed sets."""
    o, n = old.select(F.col(key).alias("k"), F.col(value).alias("o")), new.select(F.col(key).alias("k"), F.col(value).alias("n"))
    both = o.withColumn("__o", F.lit(1)).join(n.withColumn("__n", F.lit(1)), "k", "full_outer")
    action = F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "removed").when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    return both.withColumn("action", action).filter("action IS NOT NULL").select(F.col("k").alias(key), "action")


def ancestry(tables: DataFrame, extends: DataFrame) -> DataFrame:
    """M2: (tbl, ancestor, depth) of each table's ancestors at any depth, itself at 0; cycles end. Paths double at every step, so
    the number of steps is the logarithm of the depth; the graph has one row a table, the table data are not touched."""
    edge = extends.filter("parent IS NOT NULL AND parent <> tbl").select("tbl", F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))
    near = lambda df: df.groupBy("tbl", "ancestor").agg(F.min("depth").alias("depth"))
    known = cut(near(tables.select("tbl", F.col("tbl").alias("ancestor"), F.lit(0).alias("depth")).distinct().unionByName(edge)))
    size = known.agg(F.count(F.lit(1)), F.sum("depth")).first()
    while True:
        up = known.select(F.col("tbl").alias("ancestor"), F.col("ancestor").alias("top"), F.col("depth").alias("more"))
        longer = known.join(up, "ancestor").select("tbl", F.col("top").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        known = cut(near(known.unionByName(longer)))
        now = known.agg(F.count(F.lit(1)), F.sum("depth")).first()
        if now == size:
            return known
        size = now


def inherit_columns(columns: DataFrame, extends: DataFrame) -> DataFrame:
    """Columns of each table with those of its ancestors; the nearest definition wins.

    columns: (tbl, col, pos, kind); extends: (tbl, parent).
    """
    tables = columns.select("tbl").unionByName(extends.select("tbl")).distinct()
    cols = columns.select(F.col("tbl").alias("ancestor"), "col", "pos", "kind")
    found = ancestry(tables, extends).join(cols, "ancestor").groupBy("tbl", "col").agg(F.min(F.struct("depth", "pos", "kind", "ancestor")).alias("m"))
    return found.select("tbl", "col", "m.depth", "m.pos", "m.kind", F.col("m.ancestor").alias("defined_in"))


def mapping_stats(mapped: DataFrame, group: list[str]) -> DataFrame:
    """Inputs, mapped inputs, distinct targets and unmapped inputs of a resolution."""
    return mapped.groupBy(*group).agg(
        F.count(F.lit(1)).alias("input_count"), F.count("canonical").alias("mapped_input_count"), F.countDistinct("canonical").alias("mapped_unique_count"),
        F.count(F.when(F.col("canonical").isNull(), 1)).alias("unmapped_count"),
    )
