"""Queries of joins, indexes, merges, windows, set operations and resolution, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.functions import text as T
from studyloom.operators import relational as R
from studyloom.operators import resolution as Z
from studyloom.operators import templates
from studyloom.operators.repair import adult_age, contact_from_people, resolve_array
from studyloom.session import strip, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_C = F.col
TRIM = r"'^[\s\p{Z}]+|[\s\p{Z}]+$'"


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def parent_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """J1"""
    o = table(spark, d, "orders").select("o_orderkey")
    return R.drop_parents_with_children(o, table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("""WITH c AS (SELECT user_id, max(value) AS v, min(event_type) AS lo FROM events WHERE event_id % 2 = 0 GROUP BY user_id),
 e AS (SELECT user_id, max(value) AS v, max(event_type) AS hi FROM events WHERE event_id % 2 <> 0 GROUP BY user_id)
 SELECT coalesce(c.user_id, e.user_id) AS user_id, coalesce(e.v, c.v) AS v,
  CASE WHEN lo IS NULL THEN hi WHEN hi IS NULL OR hi = lo THEN lo ELSE concat(lo, ';', hi) END AS tags FROM c FULL OUTER JOIN e ON c.user_id = e.user_id""")
def event_merge(spark: SparkSession, d: str) -> DataFrame:
    """The two halves of the events merged by user."""
    e = table(spark, d, "events")
    core = e.filter("event_id % 2 = 0").groupBy("user_id").agg(F.max("value").alias("v"), F.array(F.min("event_type")).alias("tags"))
    extra = e.filter("event_id % 2 <> 0").groupBy("user_id").agg(F.max("value").alias("v"), F.array(F.max("event_type")).alias("tags"))
    return R.full_merge(core, extra, "user_id", ["v", "tags"]).withColumn("tags", F.array_join("tags", ";"))


@query("""WITH m AS (SELECT c.c_custkey, 0 AS prio, min(s.s_suppkey) AS s_suppkey FROM customer c JOIN supplier s ON c.c_custkey = s.s_suppkey GROUP BY 1
  UNION ALL SELECT c.c_custkey, 1, min(s.s_suppkey) FROM customer c JOIN supplier s ON c.c_nationkey = s.s_nationkey GROUP BY 1),
 b AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY prio, s_suppkey) AS rn FROM m)
 SELECT c.c_custkey, b.prio, b.s_suppkey FROM customer c LEFT JOIN b ON c.c_custkey = b.c_custkey AND rn = 1""")
def priority_match(spark: SparkSession, d: str) -> DataFrame:
    """J4, J5"""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", _C("s_suppkey").alias("pos"))
    return R.best_match(c, s, "c_custkey", [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")], "pos").withColumnRenamed("pos", "s_suppkey")


_K = "regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]+', '', 'g')"


@query(f"""WITH t AS (SELECT row_id AS r, 0 AS i, id AS v, {_K.format('name')} AS k FROM organisations UNION ALL SELECT row_id, 1, id, {_K.format('organisation')} FROM organisations)
 SELECT k, arg_min(v, r * 10 + i) AS canonical FROM t WHERE k <> '' AND v IS NOT NULL GROUP BY k""")
def first_wins_map(spark: SparkSession, d: str) -> DataFrame:
    """J6, U7"""
    o = table(spark, d, "organisations").filter("id IS NOT NULL")
    return R.first_wins_index(o, "row_id", "id", ["name", "organisation"], T.norm_key)


@query(f"""WITH t AS (SELECT DISTINCT id AS c, k FROM (SELECT id, {_K.format('name')} AS k FROM organisations UNION ALL SELECT id, {_K.format('organisation')} FROM organisations) WHERE k <> '' AND id IS NOT NULL)
 SELECT k, min(c) AS canonical FROM t GROUP BY k HAVING count(*) = 1""")
def unambiguous_index(spark: SparkSession, d: str) -> DataFrame:
    """J8, J9, G13, R1"""
    return R.unambiguous_index(table(spark, d, "organisations"), "id", ["name", "organisation"], T.norm_key)


@query(f"""WITH ids AS (SELECT lower(regexp_replace(id, {TRIM}, '', 'g')) AS k, min(id) AS canonical FROM organisations WHERE regexp_replace(coalesce(id, ''), {TRIM}, '', 'g') <> '' GROUP BY 1)
 SELECT r.row_id, r.publisher, coalesce(i.canonical, '') AS resolved FROM resources r LEFT JOIN ids i ON lower(regexp_replace(coalesce(r.publisher, ''), {TRIM}, '', 'g')) = i.k""")
def fk_resolve(spark: SparkSession, d: str) -> DataFrame:
    """J7, J10, J11"""
    key = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    ids = table(spark, d, "organisations").select(key(_C("id")).alias("k"), "id").filter("k <> ''").groupBy("k").agg(F.min("id").alias("canonical"))
    r = table(spark, d, "resources").select("row_id", "publisher")
    return R.resolve(r, "publisher", [("exact", ids, key)]).select("row_id", "publisher", F.coalesce("canonical", F.lit("")).alias("resolved"))


@query("""SELECT o.o_orderkey, string_agg(p.p_name, ';' ORDER BY l.l_linenumber, p.p_name) AS parts FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1""")
def fk_resolve_array(spark: SparkSession, d: str) -> DataFrame:
    """Lists of keys resolved element by element in order (equal line numbers by name)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    hit = li.join(table(spark, d, "part").select("p_partkey", "p_name"), li["l_partkey"] == _C("p_partkey"))
    names = hit.groupBy(_C("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_name"))).alias("ps"))
    return names.select("o_orderkey", F.array_join(F.transform("ps", lambda s: s["p_name"]), ";").alias("parts"))


@query("""WITH p(prefix, tbl) AS (VALUES ('', 'any'), ('E', 'e'), ('ECONOMY', 'economy'), ('S', 's'), ('SMALL', 'small'), ('PROMO', 'promo'))
 SELECT p_partkey, (SELECT tbl FROM p WHERE starts_with(p_type, prefix) ORDER BY length(prefix) DESC LIMIT 1) AS tbl FROM part""")
def prefix_longest_match(spark: SparkSession, d: str) -> DataFrame:
    """J17"""
    prefixes = spark.createDataFrame([("", "any"), ("E", "e"), ("ECONOMY", "economy"), ("S", "s"), ("SMALL", "small"), ("PROMO", "promo")], "prefix string, tbl string")
    return R.longest_prefix(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", prefixes, "prefix", "tbl").select("p_partkey", "tbl")


@query(f"""WITH ext AS (SELECT {_K.format('r_name')} AS k, r_name FROM region),
 c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'AFRICA.' WHEN 1 THEN 'Nowhere' ELSE ' ' END AS org FROM customer)
 SELECT c_custkey, CASE WHEN ext.r_name IS NOT NULL THEN r_name ELSE '' END AS organisation, CASE WHEN ext.r_name IS NULL THEN trim(org) ELSE '' END AS other FROM c LEFT JOIN ext ON ext.k = {_K.format('org')}""")
def external_refs(spark: SparkSession, d: str) -> DataFrame:
    """Hit overwrites and clears the other field, miss moves the raw value there."""
    ext = R.unambiguous_index(table(spark, d, "region"), "r_name", ["r_name"], T.norm_key)
    k = _C("c_custkey") % 3
    c = table(spark, d, "customer").select("c_custkey", F.when(k == 0, "AFRICA.").when(k == 1, "Nowhere").otherwise(" ").alias("org"))
    hit = R.resolve(c, "org", [("normalized", ext, T.norm_key)])
    return hit.select("c_custkey", F.coalesce("canonical", F.lit("")).alias("organisation"), F.when(_C("canonical").isNull(), F.trim("org")).otherwise("").alias("other"))


@query("""SELECT user_id, arg_max(CASE WHEN event_id % 4 <> 0 THEN event_type END, event_id) FILTER (WHERE event_id % 4 <> 0) AS event_type,
  arg_max(CASE WHEN event_id % 5 = 0 THEN value END, event_id) FILTER (WHERE event_id % 5 = 0 AND value IS NOT NULL) AS value FROM events GROUP BY user_id""")
def merge_last_non_null(spark: SparkSession, d: str) -> DataFrame:
    """Scalars."""
    e = table(spark, d, "events").select(
        "user_id", "event_id", F.when(_C("event_id") % 4 != 0, _C("event_type")).alias("event_type"), F.when(_C("event_id") % 5 == 0, _C("value")).alias("value")
    )
    return R.last_non_null(e, ["user_id"], "event_id", ["event_type", "value"])


@query("""WITH f AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2)
 SELECT user_id, string_agg(event_type, ';' ORDER BY first) AS kinds FROM f GROUP BY user_id""")
def merge_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists, distinct in order."""
    e = table(spark, d, "events").groupBy("user_id", F.expr("event_id div 50").alias("part")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda s: s["event_type"]).alias("kinds")
    )
    return R.merged_list(e, ["user_id"], "part", "kinds").withColumn("kinds", F.array_join("kinds", ";"))


@query("""SELECT resource, row_id, CAST(row_number() OVER (PARTITION BY resource ORDER BY row_id) AS INT) AS idx FROM subpopulation_counts WHERE n_total IS NOT NULL OR n_female IS NOT NULL OR n_male IS NOT NULL""")
def list_explode_index(spark: SparkSession, d: str) -> DataFrame:
    """P7, P12, W1"""
    c = table(spark, d, "subpopulation_counts")
    keep = F.coalesce("n_total", "n_female", "n_male").isNotNull()
    return R.dense_index(c, ["resource"], "row_id", keep).select("resource", "row_id", "idx")


_SLUG = "substr(regexp_replace(regexp_replace(lower(coalesce(organisation, name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80)"


# A slug's k-th row without an id gets the k-th free number; the slugs of these tables are numbered by no other slug.
@query(f"""WITH o AS (SELECT row_id, coalesce(resource, '') AS resource, CASE WHEN row_id % 3 = 0 THEN {_SLUG} END AS own, {_SLUG} AS slug FROM organisations WHERE coalesce(organisation, name) IS NOT NULL),
 u AS (SELECT DISTINCT resource, own FROM o WHERE own IS NOT NULL),
 n AS (SELECT row_id, o.resource, slug, row_number() OVER (PARTITION BY o.resource, slug ORDER BY row_id) + CASE WHEN u.own IS NULL THEN 0 ELSE 1 END AS k FROM o LEFT JOIN u ON u.resource = o.resource AND u.own = o.slug WHERE o.own IS NULL)
 SELECT row_id, resource, own AS uid FROM o WHERE own IS NOT NULL UNION ALL SELECT row_id, resource, CASE WHEN k = 1 THEN slug ELSE concat(slug, '-', k) END FROM n""")
def slug_unique(spark: SparkSession, d: str) -> DataFrame:
    """Organisations of a resource; every third has an id of its own."""
    written = F.coalesce("organisation", "name")
    o = table(spark, d, "organisations").filter(written.isNotNull()).select("row_id", F.coalesce("resource", F.lit("")).alias("resource"), R.slug(written).alias("slug"))
    o = o.withColumn("own", F.when(_C("row_id") % 3 == 0, _C("slug")))
    return R.unique_ids(o, ["resource"], "own", "slug", "row_id").select("row_id", "resource", "uid")


@query("""SELECT resource, age_group, arg_max(n_total, row_id) FILTER (WHERE row_id % 3 = 2 AND n_total IS NOT NULL) AS n_total,
  arg_max(n_total, row_id) FILTER (WHERE row_id % 3 = 0 AND n_total IS NOT NULL) AS n_female, arg_max(n_total, row_id) FILTER (WHERE row_id % 3 = 1 AND n_total IS NOT NULL) AS n_male
 FROM (SELECT resource, coalesce(age_group, '') AS age_group, n_total, row_id FROM subpopulation_counts) GROUP BY resource, age_group""")
def counts_pivot(spark: SparkSession, d: str) -> DataFrame:
    """G1"""
    g = F.element_at(F.array(*map(F.lit, ("Women", " m ", "all"))), (_C("row_id") % 3 + 1).cast("int"))
    c = table(spark, d, "subpopulation_counts").select("resource", F.coalesce("age_group", F.lit("")).alias("age_group"), g.alias("gender"), "n_total", F.when(_C("n_total").isNotNull(), _C("row_id")).alias("pos"))
    return R.counts_by_gender(c, ["resource", "age_group"], "gender", "n_total", "pos")


@query(f"""WITH b AS (SELECT row_id, resource, age_group, regexp_replace(coalesce(age_group, ''), {TRIM}, '', 'g') = '' AS e FROM subpopulation_counts),
 w AS (SELECT *, bool_and(e) OVER (PARTITION BY resource) AS al, bool_or(e) OVER (PARTITION BY resource) AS so FROM b)
 SELECT row_id, CASE WHEN al THEN 'All ages' ELSE coalesce(age_group, '') END AS age_group, CASE WHEN al THEN 'info' WHEN so THEN 'warning' END AS issue FROM w""")
def age_default(spark: SparkSession, d: str) -> DataFrame:
    """G2"""
    c = table(spark, d, "subpopulation_counts").select("row_id", "resource", "age_group")
    return R.age_defaults(c, ["resource"], "age_group").select("row_id", "age_group", "issue")


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL AND text <> '') WHERE rn = 1 UNION ALL SELECT doc_id FROM documents WHERE text IS NULL OR text = ''""")
def dedupe_by_identity(spark: SparkSession, d: str) -> DataFrame:
    """The first document of each text; keyless ones stay."""
    docs = table(spark, d, "documents").select("doc_id", F.when(_C("text") != "", F.md5(F.encode("text", "utf-8"))).alias("h"))
    return R.first_by_identity(docs, _C("h"), "doc_id").select("doc_id")


@query("""SELECT resource, task, count(*) AS n, count(CASE WHEN trim(coalesce(payload, '')) <> '' THEN 1 END) AS filled, bool_or(trim(coalesce(payload, '')) <> '') AS any_filled FROM section_results GROUP BY 1, 2""")
def empty_sections(spark: SparkSession, d: str) -> DataFrame:
    """G6, G12"""
    s = table(spark, d, "section_results").withColumn("f", F.trim(F.coalesce("payload", F.lit(""))) != "")
    return s.groupBy("resource", "task").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(_C("f"), 1)).alias("filled"), F.bool_or("f").alias("any_filled"))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type AS main FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c) WHERE rn = 1""")
def primary_choice(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent, then alphabetically first."""
    c = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("user_id").agg(F.min_by("event_type", F.struct(-_C("n"), _C("event_type"))).alias("main"))


@query("""SELECT task, coalesce(model, '') AS model, coalesce(finish_reason, '') AS finish_reason, count(*) AS n, CAST(sum(length(coalesce(payload, ''))) AS BIGINT) AS chars FROM section_results GROUP BY 1, 2, 3""")
def trace_rollup(spark: SparkSession, d: str) -> DataFrame:
    """G9, G10, K7"""
    e = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return table(spark, d, "section_results").groupBy("task", e("model"), e("finish_reason")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce("payload", F.lit("")))).alias("chars"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders UNION ALL SELECT -c_custkey, 'C' FROM customer), n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders UNION ALL SELECT DISTINCT -o_custkey, 'C' FROM orders
  UNION ALL SELECT -1000000000 - s_suppkey, 'S' FROM supplier)
 SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS action FROM o FULL OUTER JOIN n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL OR o.v <> n.v""")
def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """Keys of all orders and customers before, and after some statuses changed, customers without orders went and suppliers came."""
    o, c, s = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "supplier")
    status = F.when(_C("o_orderkey") % 5 == 0, "X").otherwise(_C("o_orderstatus"))
    old = o.select(_C("o_orderkey").alias("k"), _C("o_orderstatus").alias("v")).unionAll(c.select(-_C("c_custkey"), F.lit("C")))
    new = o.select(_C("o_orderkey").alias("k"), status.alias("v")).unionAll(o.select(-_C("o_custkey"), F.lit("C")).distinct()).unionAll(s.select(-1000000000 - _C("s_suppkey"), F.lit("S")))
    return R.keyed_diff(old, new, "k", "v")


@query("""SELECT doc_id, sha256(text) AS digest, CASE WHEN doc_id % 10 = 0 THEN 'changed' ELSE 'same' END AS state FROM documents WHERE text IS NOT NULL""")
def manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    """Content hashes of two states of a set."""
    docs = table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.sha2(F.encode("text", "utf-8"), 256).alias("digest"))
    later = docs.withColumn("digest", F.when(_C("doc_id") % 10 == 0, F.lit("x")).otherwise(_C("digest")))
    diff = R.keyed_diff(docs, later, "doc_id", "digest")
    return docs.join(diff, "doc_id", "left").select("doc_id", "digest", F.coalesce("action", F.lit("same")).alias("state"))


_MODEL = [("Base", "id", 1, "string"), ("Base", "name", 2, "string"), ("Base", "type", 3, "ontology"), ("Mid", "name", 1, "text"), ("Mid", "year", 2, "int"), ("Leaf", "type", 1, "ontology_array"), ("Leaf", "pid", 2, "string"), ("Loop", "x", 1, "int")]
_EXT = [("Mid", "Base"), ("Leaf", "Mid"), ("Loop", "Leaf"), ("Base", "Loop")]
_VALUES = lambda rows: ", ".join(str(r) for r in rows)


@query(f"""WITH RECURSIVE c(tbl, col, pos, kind) AS (VALUES {_VALUES(_MODEL)}), e(tbl, parent) AS (VALUES {_VALUES(_EXT)}),
 anc(tbl, ancestor, depth) AS (SELECT DISTINCT tbl, tbl, 0 FROM c UNION ALL SELECT a.tbl, e.parent, a.depth + 1 FROM anc a JOIN e ON e.tbl = a.ancestor WHERE a.depth < 40 AND e.parent <> a.tbl),
 m AS (SELECT a.tbl, c.col, a.depth, CAST(c.pos AS BIGINT) AS pos, c.kind, a.ancestor, row_number() OVER (PARTITION BY a.tbl, c.col ORDER BY a.depth, c.pos) AS rn FROM (SELECT tbl, ancestor, min(depth) AS depth FROM anc GROUP BY 1, 2) a JOIN c ON c.tbl = a.ancestor)
 SELECT tbl, col, depth, pos, kind, ancestor AS defined_in FROM m WHERE rn = 1""")
def registry_inherit(spark: SparkSession, d: str) -> DataFrame:
    """M1, M2, M17, U5, J13, P13"""
    cols = spark.createDataFrame(_MODEL, "tbl string, col string, pos long, kind string")
    ext = spark.createDataFrame(_EXT, "tbl string, parent string")
    return R.inherit_columns(cols, ext)


@query("""WITH f(col, src) AS (VALUES ('country', 'countries'), ('area', 'regions'), ('theme', 'themes')), s AS (SELECT 'countries' AS src, name FROM countries UNION ALL SELECT 'regions', name FROM regions)
 SELECT col, src FROM f WHERE src NOT IN (SELECT src FROM s WHERE name IS NOT NULL)""")
def missing_ontology(spark: SparkSession, d: str) -> DataFrame:
    """Columns whose list has no value."""
    f = spark.createDataFrame([("country", "countries"), ("area", "regions"), ("theme", "themes")], "col string, src string")
    have = table(spark, d, "countries").select(F.lit("countries").alias("src"), "name").unionAll(table(spark, d, "regions").select(F.lit("regions").alias("src"), "name"))
    return f.join(have.filter("name IS NOT NULL").select("src").distinct(), "src", "left_anti").select("col", "src")


_UNION = "(SELECT 'countries' AS lst, * FROM countries UNION ALL SELECT 'regions', * FROM regions)"
_CASCADE = f"""WITH l AS (SELECT lst, trim(name) AS c, unnest([name, label, acronym, code, ontology_term_uri, id]) AS tok FROM {_UNION} WHERE trim(coalesce(name, '')) <> ''),
 ex AS (SELECT lst, trim(tok) AS k, min(c) AS canonical FROM l WHERE trim(coalesce(tok, '')) <> '' GROUP BY 1, 2 HAVING count(DISTINCT c) = 1),
 no AS (SELECT lst, {_K.format('tok')} AS k, min(c) AS canonical FROM l WHERE {_K.format('tok')} <> '' GROUP BY 1, 2 HAVING count(DISTINCT c) = 1),
 ca AS (SELECT lst, {_K.format('c')} AS k, min(c) AS canonical FROM l WHERE {_K.format('c')} <> '' GROUP BY 1, 2 HAVING count(DISTINCT c) = 1),
 m AS (SELECT match_id, field, raw, coalesce(ex.canonical, no.canonical, ca.canonical) AS canonical, CASE WHEN regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g') = '' THEN 'empty' WHEN ex.canonical IS NOT NULL THEN 'exact'
   WHEN no.canonical IS NOT NULL THEN 'normalized' WHEN ca.canonical IS NOT NULL THEN 'normalized_canonical' ELSE 'unmapped' END AS method
  FROM choice_matches LEFT JOIN ex ON ex.lst = field AND ex.k = regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g') LEFT JOIN no ON no.lst = field AND no.k = {_K.format('raw')}
  LEFT JOIN ca ON ca.lst = field AND ca.k = {_K.format('raw')})"""


def _matched(spark: SparkSession, d: str, stages, fuzzy: bool, cutoffs: dict | None = None) -> DataFrame:
    """(match_id, field, raw, canonical, method, suggestions) of every typed value against the list of its field."""
    both = None
    for lst in ("countries", "regions"):
        rows = table(spark, d, "choice_matches").filter(_C("field") == lst).select("match_id", "field", "raw")
        found = Z.match_values(rows, "raw", stages(table(spark, d, lst), lst), cutoff=(cutoffs or {}).get(lst, Z.CUTOFF), fuzzy=fuzzy)
        done = Z.with_matches(rows, "raw", found).withColumnRenamed("mapped", "canonical")
        both = done if both is None else both.unionAll(done)
    return both


def _cascade(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d, lambda entries, lst: Z.choice_stages(entries), fuzzy=False).drop("suggestions")


@query(f"{_CASCADE} SELECT match_id, field, raw, canonical, method FROM m")
def ontology_cascade(spark: SparkSession, d: str) -> DataFrame:
    """The stages before the fuzzy one."""
    return _cascade(spark, d)


@query(f"""{_CASCADE} SELECT field, count(*) AS input_count, count(canonical) AS mapped_input_count, count(DISTINCT canonical) AS mapped_unique_count, count(*) - count(canonical) AS unmapped_count FROM m GROUP BY field""")
def ontology_stats(spark: SparkSession, d: str) -> DataFrame:
    """G7, G8"""
    return R.mapping_stats(_cascade(spark, d), ["field"])


@query(f"""{_CASCADE} SELECT field, 'warning' AS severity, concat('no entry for ', raw) AS message, count(*) AS n FROM m WHERE canonical IS NULL AND trim(coalesce(raw, '')) <> '' GROUP BY field, raw""")
def ontology_issues(spark: SparkSession, d: str) -> DataFrame:
    """R11, K5"""
    miss = _cascade(spark, d).filter("canonical IS NULL AND trim(coalesce(raw, '')) <> ''")
    return miss.groupBy("field", F.lit("warning").alias("severity"), F.concat(F.lit("no entry for "), "raw").alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query()
def ontology_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Choices of both lists with all stages, method and suggestions."""
    return _matched(spark, d, lambda entries, lst: Z.choice_stages(entries), fuzzy=True).withColumn("suggestions", F.array_join("suggestions", " | "))


_PLACE = "trim(regexp_replace(regexp_replace({}, '[()\\[\\]*''’`\".,;/_-]+', ' ', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g'))"
_BARE = "trim(replace(lower(strip_accents(coalesce({}, ''))), '&', ' and '))"
_ALIAS = ", ".join("('{}', '{}', '{}')".format(lst, k.replace("'", "''"), v.replace("'", "''")) for lst, t in (("countries", Z.COUNTRY_ALIASES), ("regions", Z.REGION_ALIASES)) for k, v in t.items())
_GEO = f"""WITH l AS (SELECT lst, trim(name) AS name, upper(trim(coalesce(code, ''))) AS code, {_PLACE.format("CASE WHEN lst = 'countries' THEN replace(" + _BARE.format('name') + ", '(the)', '') ELSE " + _BARE.format('name') + " END")} AS k FROM {_UNION} WHERE trim(coalesce(name, '')) <> ''),
 al(lst, k, name) AS (VALUES {_ALIAS}), co AS (SELECT lst, code AS k, max(name) AS c FROM l WHERE code <> '' GROUP BY 1, 2), lo AS (SELECT lst, lower(name) AS k, max(name) AS c FROM l GROUP BY 1, 2),
 ak AS (SELECT DISTINCT al.lst, al.k, al.name AS c FROM al JOIN l ON l.lst = al.lst AND l.name = al.name),
 no AS (SELECT lst, k, min(name) AS c FROM (SELECT lst, k, name FROM l UNION ALL SELECT lst, regexp_replace(k, '^the\\s+', ''), name FROM l WHERE lst = 'countries') WHERE k <> '' GROUP BY 1, 2),
 r AS (SELECT match_id, field, raw, regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g') AS t, {_PLACE.format("CASE WHEN field = 'countries' THEN replace(" + _BARE.format('raw') + ", '(the)', '') ELSE " + _BARE.format('raw') + " END")} AS k FROM choice_matches)
 SELECT match_id, field, raw, coalesce(co.c, lo.c, ak.c, no.c) AS canonical, CASE WHEN t = '' THEN 'empty' WHEN co.c IS NOT NULL THEN 'code' WHEN lo.c IS NOT NULL THEN 'exact_name' WHEN ak.c IS NOT NULL THEN 'alias' WHEN no.c IS NOT NULL THEN 'normalized_name' ELSE 'unmapped' END AS method
 FROM r LEFT JOIN co ON co.lst = field AND co.k = upper(t) LEFT JOIN lo ON lo.lst = field AND lo.k = lower(t) LEFT JOIN ak ON ak.lst = field AND ak.k = r.k LEFT JOIN no ON no.lst = field AND no.k = r.k"""


@query(_GEO)
def place_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Countries and regions by code, name, alias and normalised name."""
    return _matched(spark, d, lambda entries, lst: Z.place_stages(entries, lst == "countries"), fuzzy=False).drop("suggestions")


@query()
def place_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Countries and regions with all stages, method and suggestions."""
    done = _matched(spark, d, lambda entries, lst: Z.place_stages(entries, lst == "countries"), True, {"regions": Z.REGION_CUTOFF})
    return done.withColumn("suggestions", F.array_join("suggestions", " | "))


@query(f"""WITH {_CASCADE[5:]}, v AS (SELECT row_id, trim(regexp_replace(x, {TRIM}, '', 'g')) AS raw, i FROM (SELECT row_id, unnest(string_split(regions, ';')) AS x, generate_subscripts(string_split(regions, ';'), 1) AS i FROM resources WHERE regions IS NOT NULL) WHERE regexp_replace(x, {TRIM}, '', 'g') <> ''),
 o AS (SELECT row_id, row_number() OVER (ORDER BY row_id) AS rn FROM resources),
 s AS (SELECT o.rn, v.raw, v.i, coalesce(ex.canonical, no.canonical, ca.canonical) AS c FROM v JOIN o ON o.row_id = v.row_id LEFT JOIN ex ON ex.lst = 'regions' AND ex.k = v.raw LEFT JOIN no ON no.lst = 'regions' AND no.k = {_K.format('v.raw')} LEFT JOIN ca ON ca.lst = 'regions' AND ca.k = {_K.format('v.raw')})
 SELECT 'cell' AS kind, rn AS row_no, string_agg(coalesce(c, raw), ',' ORDER BY i) AS val FROM s GROUP BY rn UNION ALL SELECT 'issue', rn + 1, raw FROM s WHERE c IS NULL""")
def mapped_cells(spark: SparkSession, d: str) -> DataFrame:
    """Regions of resources mapped in place, and an issue for each value without an entry, by row of the sheet."""
    cells = R.global_index(table(spark, d, "resources").select("row_id", "regions"), "row_id").filter("regions IS NOT NULL")
    parts = F.filter(F.transform(F.split("regions", ";"), strip), lambda x: x != "")
    cells = cells.select(_C("idx").cast("long").alias("row_no"), parts.alias("items"))
    found = Z.match_values(cells.select(F.explode("items").alias("v")), "v", Z.choice_stages(table(spark, d, "regions")), fuzzy=False)
    done, issues = Z.map_list_cells(cells, "row_no", "items", found)
    return done.select(F.lit("cell").alias("kind"), "row_no", _C("cell").alias("val")).unionAll(issues.select(F.lit("issue"), "row_no", "raw"))


@query(f"""WITH t AS (SELECT DISTINCT trim(name) AS c, {_K.format('tok')} AS n, trim(tok) AS x FROM (SELECT name, unnest([name, code, id]) AS tok FROM regions) WHERE trim(coalesce(tok, '')) <> ''),
 ex AS (SELECT x AS k, min(c) AS c FROM t GROUP BY 1 HAVING count(DISTINCT c) = 1), no AS (SELECT n AS k, min(c) AS c FROM t WHERE n <> '' GROUP BY 1 HAVING count(DISTINCT c) = 1),
 r AS (SELECT match_id, regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g') AS a, regexp_replace(coalesce(mapped, ''), {TRIM}, '', 'g') AS b FROM choice_matches),
 m AS (SELECT match_id, a, b, coalesce(ea.c, na.c, eb.c, nb.c) AS hit FROM r LEFT JOIN ex ea ON ea.k = a LEFT JOIN no na ON na.k = {_K.format('a')} LEFT JOIN ex eb ON eb.k = b LEFT JOIN no nb ON nb.k = {_K.format('b')})
 SELECT match_id, coalesce(hit, '') AS organisation, CASE WHEN hit IS NOT NULL THEN '' WHEN a <> '' AND b = '' THEN a ELSE b END AS other FROM m""")
def external_values(spark: SparkSession, d: str) -> DataFrame:
    """A value, else another, mapped to an external list; what has no entry moves to the other field."""
    rows = table(spark, d, "choice_matches").select("match_id", _C("raw").alias("organisation"), _C("mapped").alias("other"))
    return Z.external_organisations(rows, "organisation", "other", table(spark, d, "regions").select("name", "code", "id"), fuzzy=False)


@query("""SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS backend FROM orders""")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Backend of each dense index, without a global window."""
    return R.global_index(table(spark, d, "orders").select("o_orderkey"), "o_orderkey").select("o_orderkey", ((_C("idx") - 1) % 7).alias("backend"))


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM lineitem) WHERE rn <= 2""")
def page_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first two items of each parent (a cap is the feature)."""
    return R.dense_index(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", F.lit(True), "rn").filter("rn <= 2").select("l_orderkey", "l_linenumber")


@query("""WITH p(code, task) AS (VALUES ('A', 'overview'), ('B', 'design'), ('D1', 'events core'), ('D2', 'events detail'), ('F1', 'organisations'), ('F2', 'people')) SELECT code, task FROM p WHERE code IN ('A', 'D1', 'D2')""")
def pass_plan(spark: SparkSession, d: str) -> DataFrame:
    """Split passes expand to their parts."""
    plan = spark.createDataFrame([("A", "overview"), ("B", "design"), ("D1", "events core"), ("D2", "events detail"), ("F1", "organisations"), ("F2", "people")], "code string, task string")
    wanted = {p for code in ("A", "D") for p in {"D": ("D1", "D2"), "F": ("F1", "F2")}.get(code, (code,))}
    return plan.filter(_C("code").isin(*sorted(wanted)))


@query("""SELECT row_id, coalesce(resource, '') AS resource, coalesce(name, '') AS name, '' AS logo, lower(trim(coalesce(type, ''))) <> 'individual' AS is_organisation FROM organisations""")
def project_row(spark: SparkSession, d: str) -> DataFrame:
    """Listed columns only, missing ones blank."""
    return table(spark, d, "organisations").select(
        "row_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("resource", "name")], F.lit("").alias("logo"), (F.lower(F.trim(F.coalesce("type", F.lit("")))) != "individual").alias("is_organisation")
    )


@query("""WITH p AS (SELECT resource, row_id, first_name, last_name, email FROM contacts WHERE resource IS NOT NULL AND length(trim(coalesce(first_name, ''))) > 1),
 c AS (SELECT row_id, resource, first_name, last_name, email FROM contacts),
 h AS (SELECT c.row_id, min(p.row_id) AS hit FROM c JOIN p ON p.resource = c.resource AND ((lower(trim(coalesce(p.email, ''))) <> '' AND lower(trim(p.email)) = lower(trim(c.email))) OR (lower(trim(coalesce(p.last_name, ''))) <> '' AND lower(trim(p.last_name)) = lower(trim(c.last_name)))) GROUP BY 1),
 r AS (SELECT c.*, length(trim(coalesce(c.first_name, ''))) <= 1 AS short, p.first_name AS pf, p.last_name AS pl, p.email AS pe FROM c LEFT JOIN h ON h.row_id = c.row_id LEFT JOIN p ON p.row_id = h.hit)
 SELECT row_id, CASE WHEN short THEN coalesce(pf, first_name) ELSE first_name END AS first_name, CASE WHEN short AND trim(coalesce(last_name, '')) = '' THEN pl ELSE last_name END AS last_name,
  CASE WHEN short AND trim(coalesce(email, '')) = '' THEN pe ELSE email END AS email FROM r""")
def contact_repair(spark: SparkSession, d: str) -> DataFrame:
    """Contacts without a first name completed from the people of their resource (the first match by row_id)."""
    c = table(spark, d, "contacts").select("row_id", "resource", "first_name", "last_name", "email")
    low = lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))
    # Only people who share a key with a contact meet it: equi-joins, one person a contact and key.
    people = c.filter("resource IS NOT NULL AND length(trim(coalesce(first_name, ''))) > 1")
    hits = None
    for key in ("email", "last_name"):
        firsts = people.select("resource", low(_C(key)).alias("k"), F.struct("row_id", "first_name", "last_name", "email").alias("p")).filter("k <> ''").groupBy("resource", "k").agg(F.min("p").alias("p"))
        h = c.select("row_id", "resource", low(_C(key)).alias("k")).join(firsts, ["resource", "k"]).select("row_id", "p")
        hits = h if hits is None else hits.unionAll(h)
    best = hits.groupBy("row_id").agg(F.min("p").alias("p"))
    full = c.join(best, "row_id", "left").withColumn("people", F.array_compact(F.array("p")))
    fixed = contact_from_people(_C("first_name"), _C("last_name"), _C("email"), _C("people")).alias("f")
    return full.select("row_id", fixed).select("row_id", "f.first_name", "f.last_name", "f.email")


@query("""SELECT row_id, CASE WHEN row_id % 2 = 0 AND age_min < 18 THEN NULL ELSE age_min END AS age_min FROM resources""")
def age_contradiction(spark: SparkSession, d: str) -> DataFrame:
    """N14"""
    groups = F.when(_C("row_id") % 2 == 0, F.array(F.lit(" Adults (18+)"))).otherwise(F.array(F.lit("Children")))
    return table(spark, d, "resources").select("row_id", adult_age(_C("age_min"), groups).alias("age_min"))


@query(f"""WITH l AS (SELECT DISTINCT {_K.format('r_name')} AS k, r_name FROM region), o AS (SELECT o_orderkey, [upper(o_orderstatus), 'asia.', 'Europe', 'ASIA', ''] AS xs FROM orders),
 x AS (SELECT o_orderkey, unnest(xs) AS raw, unnest(range(5)) AS pos FROM o), m AS (SELECT o_orderkey, r_name, min(pos) AS pos FROM x JOIN l ON l.k = {_K.format('raw')} AND l.k <> '' GROUP BY 1, 2)
 SELECT o.o_orderkey, coalesce(string_agg(m.r_name, ';' ORDER BY m.pos), '') AS names FROM o LEFT JOIN m ON m.o_orderkey = o.o_orderkey GROUP BY 1""")
def ontology_array(spark: SparkSession, d: str) -> DataFrame:
    """R6, R7"""
    ix = R.unambiguous_index(table(spark, d, "region"), "r_name", ["r_name"], T.norm_key)
    o = table(spark, d, "orders").select("o_orderkey", F.array(F.upper("o_orderstatus"), F.lit("asia."), F.lit("Europe"), F.lit("ASIA"), F.lit("")).alias("names"))
    return resolve_array(o, "o_orderkey", "names", [("normalized", ix, T.norm_key)]).withColumn("names", F.array_join("names", ";"))


_OLD = {"task_a": '{"name": "string|null", "tags": ["string"], "sub": [{"x": "integer|null", "y": "string|null"}]}', "task_b": '{"k": "string"}'}
_NEW = {"task_a": '{"name": "string|null", "tags": ["integer"], "sub": [{"x": "integer|null", "z": "string|null"}]}', "task_c": '{"k": "string"}'}


@query("""SELECT * FROM (VALUES ('task_a', 'tags[]', 'changed'), ('task_a', 'sub[].y', 'removed'), ('task_a', 'sub[].z', 'added'), ('task_b', 'k', 'removed'), ('task_c', 'k', 'added')) t(task, path, action)""")
def template_changes(spark: SparkSession, d: str) -> DataFrame:
    """A18, A19, U1"""
    return templates.template_diff(templates.template_table(spark, _OLD), templates.template_table(spark, _NEW))


@query("""SELECT 'seg' AS path, concat('seg: one of ', (SELECT string_agg(s, ', ' ORDER BY s) FROM (SELECT DISTINCT c_mktsegment AS s FROM customer))) AS line
 UNION ALL SELECT 'country', concat('country: one of ', (SELECT count(DISTINCT name) FROM countries), ' values of countries')""")
def constraint_lines(spark: SparkSession, d: str) -> DataFrame:
    """M4"""
    fields = spark.createDataFrame([("seg", "customer"), ("country", "countries"), ("none", "nowhere")], "path string, src string")
    c = table(spark, d, "customer").select(F.lit("customer").alias("src"), _C("c_mktsegment").alias("name")).distinct()
    return templates.constraint_lines(fields, c.unionAll(table(spark, d, "countries").select(F.lit("countries").alias("src"), "name")))


@query("""SELECT o_orderkey, CAST(b AS BIGINT) AS block, CASE b WHEN 1 THEN 'Name' WHEN 2 THEN 'Type' END AS head, CASE b WHEN 0 THEN 'intro' WHEN 1 THEN concat('- ', o_orderstatus, chr(10), '- second') ELSE o_orderpriority END AS body FROM orders, (VALUES (0), (1), (2)) v(b)""")
def instruction_blocks(spark: SparkSession, d: str) -> DataFrame:
    """T28"""
    t = F.concat(F.lit("intro\nName:\n- "), _C("o_orderstatus"), F.lit("\n- second\nType:\n"), _C("o_orderpriority"))
    return templates.blocks(table(spark, d, "orders").select("o_orderkey", t.alias("t")), "o_orderkey", "t")


@query()
def text_changes(spark: SparkSession, d: str) -> DataFrame:
    """Unified difference of each paper's text and its cleaned text."""
    p = table(spark, d, "pdf_text").select("paper_id", F.coalesce("paper_text", F.lit("")).alias("a"))
    clean = F.regexp_replace(F.regexp_replace("a", "\r", ""), "[ \t]+\n", "\n")
    return p.select("paper_id", (F.length(clean) - F.length("a")).alias("delta"), templates.capped_lines(templates.text_diff(_C("a"), clean), 1000).alias("diff"))
