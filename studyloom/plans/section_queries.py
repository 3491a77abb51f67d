"""Queries of answers, rows made of sections, repairs across sections and the registry, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.operators import answers as X
from studyloom.operators import registry as G
from studyloom.operators import sections as S
from studyloom.operators import workbook as V
from studyloom.plans.text_queries import _BARE, _DOI, _FEE, _PART, _REQ, TRIM, _nws
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


@query()
def answer_salvage(spark: SparkSession, d: str) -> DataFrame:
    """What can be read of every answer, cut-off ones included."""
    got = X.answers(table(spark, d, "section_results").select("section_id", "task", "payload"), "payload")
    return got.select("section_id", "task", "how", F.length("value").alias("n_chars"), F.coalesce(F.size(F.json_object_keys("value")), F.lit(0)).alias("n_keys"), F.md5(F.encode("value", "utf-8")).alias("digest"))


@query()
def section_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of the overview and subpopulation sections as columns in the order of their templates."""
    s = table(spark, d, "section_results").filter("task IN ('task_overview', 'task_subpopulations')")
    wide = s.select("section_id", *[F.when(_C("task") == t, _C("payload")).alias(t) for t in ("task_overview", "task_subpopulations")])
    out = X.section_columns(wide, {"task_overview": ["pid", "name", "acronym", "type", "keywords", "start_year", "external_identifiers"], "task_subpopulations": ["subpopulations"]})
    return out.toDF(*[c.replace(".", "_") for c in out.columns])


@query(f"""SELECT row_id, CASE WHEN regexp_replace(coalesce(pid, ''), {TRIM}, '', 'g') <> '' THEN {_BARE.format("regexp_replace(pid, " + TRIM + ", '', 'g')")} WHEN regexp_replace(coalesce(name, ''), {TRIM}, '', 'g') <> '' THEN name
 WHEN regexp_replace(coalesce(acronym, ''), {TRIM}, '', 'g') <> '' THEN acronym ELSE concat('paper-', row_id) END AS ref FROM resources""")
def resource_refs(spark: SparkSession, d: str) -> DataFrame:
    """T16"""
    r = table(spark, d, "resources")
    return r.select("row_id", X.resource_ref(F.concat(F.lit("paper-"), "row_id"), _C("pid"), _C("name"), _C("acronym")).alias("ref"))


@query("""SELECT code, concat(trim(name), CASE WHEN label IS NOT NULL AND trim(label) <> trim(name) THEN concat('|', trim(label)) ELSE '' END) AS names FROM countries WHERE name IS NOT NULL AND strpos(name, '''') = 0 AND strpos(coalesce(label, ''), '"') = 0
 UNION ALL SELECT code, concat(trim(name), CASE WHEN label IS NOT NULL AND trim(label) <> trim(name) THEN concat('|', trim(label)) ELSE '' END) FROM regions WHERE name IS NOT NULL AND strpos(name, '''') = 0 AND strpos(coalesce(label, ''), '"') = 0""")
def default_values(spark: SparkSession, d: str) -> DataFrame:
    """Defaults written as objects with names."""
    both = table(spark, d, "countries").select("code", "name", "label").unionAll(table(spark, d, "regions").select("code", "name", "label"))
    plain = both.filter("name IS NOT NULL AND instr(name, \"'\") = 0 AND instr(coalesce(label, ''), '\"') = 0")
    s = F.concat(F.lit("[{name: '"), _C("name"), F.lit("'}"), F.coalesce(F.concat(F.lit(', {name:"'), _C("label"), F.lit('"}')), F.lit("")), F.lit(", {name:'"), _C("name"), F.lit("'}]"))
    return plain.select("code", F.array_join(X.default_names(s), "|").alias("names"))


_HEALTH = "('clinical trial', 'cohort study', 'registry', 'disease specific', 'health records', 'biobank')"


@query(f"""SELECT row_id, lower(coalesce(type, '')) IN {_HEALTH} OR list_contains(list_transform(string_split(coalesce(keywords, ''), ';'), lambda x: lower(x)), 'health') AS exact,
 regexp_matches(regexp_replace(lower(coalesce(type, '')), '[^a-z0-9]+', '', 'g'), 'clinical|cohort|registry|healthrecords|biobank') OR list_contains(list_transform(string_split(coalesce(keywords, ''), ';'), lambda x: regexp_replace(lower(x), '[^a-z0-9]+', '', 'g')), 'health') AS loose FROM resources""")
def health_contexts(spark: SparkSession, d: str) -> DataFrame:
    """Both variants."""
    types, themes = F.array("type"), F.split(F.coalesce("keywords", F.lit("")), ";")
    return table(spark, d, "resources").select("row_id", X.health_context(types, themes).alias("exact"), X.health_context(types, themes, loose=True).alias("loose"))


@query(f"""WITH k AS (SELECT row_id, list_filter(list_transform(string_split(coalesce(keywords, ''), ';'), lambda x: regexp_replace(x, {TRIM}, '', 'g')), lambda x: x <> '') AS xs FROM resources)
 SELECT row_id, concat('[', array_to_string(list_transform(xs, lambda x: CAST(to_json(x) AS VARCHAR)), ', '), ']') AS as_json, array_to_string(xs, '; ') AS as_text FROM k""")
def written_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists as JSON and as plain text."""
    xs = X.list_texts(F.transform(F.split(F.coalesce("keywords", F.lit("")), ";"), strip))
    return table(spark, d, "resources").select("row_id", X.list_json(xs).alias("as_json"), X.text_field(xs).alias("as_text"))


@query("""SELECT row_id, coalesce(CAST(start_year AS VARCHAR), '') AS "start year", coalesce(acronym, '') AS "short name", coalesce(design, '') AS design, CASE WHEN regexp_replace(coalesce(id, ''), '[\\s\\p{Z}]', '', 'g') = '' THEN 'none' ELSE id END AS resource, '' AS logo FROM resources""")
def dynamic_rows(spark: SparkSession, d: str) -> DataFrame:
    """Keys written in many ways, dealt to the columns of a table."""
    item = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("k"), _C(c).cast("string").alias("v")) for k, c in (("start_year", "start_year"), ("Acro-Nym!", "acronym"), ("DESIGN", "design"), ("re source", "id"), ("unknown", "name"))]))
    rows = table(spark, d, "resources").select("row_id", item.alias("item"))
    return X.dynamic_row(rows, "item", ["start year", "short name", "design", "resource", "logo"], {"Acro-Nym!": "short name"}, ref=F.lit("none"))


@query("""SELECT event_id, len(json_keys(props)) AS n, json_extract_string(props, '$.k') AS k FROM events UNION ALL SELECT -section_id, 0, NULL FROM section_results WHERE task = 'none' """)
def json_maps(spark: SparkSession, d: str) -> DataFrame:
    """P15"""
    m = X.json_map(_C("props"))
    return table(spark, d, "events").select("event_id", F.size(m).cast("long").alias("n"), F.try_element_at(m, F.lit("k")).alias("k"))


_PAPERS = "(SELECT resource, arg_min(paper_text, paper_id) AS text, min(paper_id) AS paper_id FROM pdf_text WHERE paper_text IS NOT NULL GROUP BY resource)"


@query(f"""WITH r AS (SELECT row_id, type, pid, name, number_of_participants AS n, access_rights AS ar, data_access_fee AS fee, keywords, age_min, countries, coalesce(p.text, '') AS t FROM resources LEFT JOIN {_PAPERS} p ON p.resource = resources.id),
 h AS (SELECT *, {_nws('t')} AS w, lower(coalesce(type, '')) IN {_HEALTH} AS health FROM r),
 k AS (SELECT row_id, regexp_replace(x, {TRIM}, '', 'g') AS o, i FROM (SELECT row_id, unnest(regexp_split_to_array(coalesce(keywords, ''), '[;,]')) AS x, generate_subscripts(regexp_split_to_array(coalesce(keywords, ''), '[;,]'), 1) AS i FROM r)),
 l AS (SELECT row_id, string_agg(o, '; ' ORDER BY i) AS options FROM (SELECT row_id, arg_min(o, i) AS o, min(i) AS i FROM k WHERE o <> '' AND NOT regexp_matches(o, '(?i)\\b(survival|mortality|outcome|response|recurrence)\\b') GROUP BY row_id, lower(o)) GROUP BY row_id)
 SELECT h.row_id, CASE WHEN h.row_id % 2 = 0 AND age_min < 18 THEN NULL ELSE age_min END AS age_min, coalesce(n, CAST(nullif(regexp_extract(w, '{_PART}', 1), '') AS BIGINT)) AS number_of_participants,
  CASE WHEN regexp_replace(coalesce(ar, ''), {TRIM}, '', 'g') = '' AND regexp_matches(w, '(?i){_REQ}') THEN 'Restricted access' ELSE ar END AS access_rights,
  CASE WHEN fee AND NOT regexp_matches(w, '{_FEE}') THEN NULL ELSE fee END AS data_access_fee, CASE WHEN regexp_replace(coalesce(keywords, ''), {TRIM}, '', 'g') = '' THEN keywords ELSE l.options END AS linkage_options,
  CASE WHEN regexp_replace(coalesce(pid, ''), {TRIM}, '', 'g') = '' THEN coalesce(nullif(regexp_replace(regexp_extract(w, '\\b({_DOI})\\b', 1), '[.,;:)]+$', ''), ''), pid) ELSE pid END AS pid,
  CASE WHEN health THEN 'Health' ELSE '' END AS themes, CASE WHEN health THEN 'Privacy Act|Data Governance Act' ELSE 'Privacy Act' END AS laws,
  CASE WHEN trim(coalesce(name, '')) <> '' AND h.row_id % 3 = 0 AND NOT regexp_matches(name, '(?i)\\b(study|cohort|biobank|registry|trial|database|databank|network)\\b') THEN NULL ELSE name END AS name
 FROM h LEFT JOIN l ON l.row_id = h.row_id""")
def section_repair(spark: SparkSession, d: str) -> DataFrame:
    """M14 with T11, T12, T23, T24, N14, A22: resources repaired from the text of their first paper."""
    texts = table(spark, d, "pdf_text").filter("paper_text IS NOT NULL").groupBy("resource").agg(F.min_by("paper_text", "paper_id").alias("t"))
    r = table(spark, d, "resources").join(texts.withColumnRenamed("resource", "id"), "id", "left")
    even = _C("row_id") % 2 == 0
    wide = r.select(
        "row_id", F.array("type").alias("types"), F.array().cast("array<string>").alias("themes"), F.array(F.lit("Privacy Act")).alias("laws"), "pid", "name", "number_of_participants",
        "access_rights", "data_access_fee", _C("keywords").alias("linkage_options"), "age_min", F.when(even, F.array(F.lit("Adult (18+ years)"))).otherwise(F.array(F.lit("All ages"))).alias("groups"),
        F.when(_C("row_id") % 3 == 0, F.array(F.upper("name"))).otherwise(F.array().cast("array<string>")).alias("titles"), F.coalesce("t", F.lit("")).alias("t"),
    )
    done = S.repaired_sections(wide, "t")
    return done.select("row_id", "age_min", "number_of_participants", "access_rights", "data_access_fee", "linkage_options", "pid", F.array_join("themes", "|").alias("themes"), F.array_join("laws", "|").alias("laws"), "name")


@query(f"""WITH r AS (SELECT row_id, coalesce(access_rights, '') AS ar, regexp_matches(regexp_replace(lower(coalesce(type, '')), '[^a-z0-9]+', '', 'g'), 'clinical|cohort|registry|healthrecords|biobank') AS health, row_id % 2 = 0 AS asked FROM resources)
 SELECT row_id, CASE WHEN regexp_replace(ar, {TRIM}, '', 'g') = '' AND asked THEN 'Controlled access' ELSE ar END AS access_rights, CASE WHEN health THEN 'Health|Care' ELSE '' END AS themes,
  CASE WHEN health THEN 'Act A|Act B' ELSE 'Act A' END AS laws FROM r""")
def schema_defaulted(spark: SparkSession, d: str) -> DataFrame:
    """M13 with T26, T27, T32: defaults of the model."""
    none = F.array().cast("array<string>")
    r = table(spark, d, "resources").select(
        "row_id", F.coalesce("access_rights", F.lit("")).alias("access_rights"), F.array("type").alias("types"), none.alias("themes"), F.array(F.lit("Act A")).alias("laws"),
        F.when(_C("row_id") % 2 == 0, "Data are available upon request.").otherwise("Closed.").alias("t"),
    )
    done = S.schema_defaults(r, "t", F.array(F.lit("Open"), F.lit("Controlled access"), F.lit("Restricted access")), F.lit("[{name:'Health'},{name:'Care'}]"), F.lit("[{name:'Act A'},{name:'Act B'}]"))
    return done.select("row_id", "access_rights", F.array_join("themes", "|").alias("themes"), F.array_join("laws", "|").alias("laws"))


# Model rows from the parts table: a brand extends its maker (the first digit of its number); makers have types as columns, brands sizes.
_ROWS = """m AS (SELECT substr(p_brand, 1, length(p_brand) - 1) AS tbl, '' AS parent, p_type AS col, 'string' AS kind, '' AS ref, CAST(p_partkey AS BIGINT) AS pos FROM part
 UNION ALL SELECT p_brand, substr(p_brand, 1, length(p_brand) - 1), concat('size ', p_size), CASE WHEN p_size % 3 = 0 THEN 'ontology' ELSE 'int' END, CASE WHEN p_size % 2 = 0 THEN 'countries' ELSE 'regions' END, CAST(p_partkey AS BIGINT) + 1000000000 FROM part)"""
_REGISTRY = f"""WITH {_ROWS}, e AS (SELECT tbl, arg_max(parent, pos) AS parent FROM m WHERE parent <> '' GROUP BY 1), o AS (SELECT tbl, col, min(pos) AS pos, arg_max(kind, pos) AS kind, arg_max(ref, pos) AS ref FROM m GROUP BY 1, 2),
 a AS (SELECT DISTINCT tbl, tbl AS ancestor, 0 AS depth FROM o UNION ALL SELECT tbl, parent, 1 FROM e), f AS (SELECT a.tbl, o.col, a.depth, o.pos, o.kind, o.ref, a.ancestor, row_number() OVER (PARTITION BY a.tbl, o.col ORDER BY a.depth, o.pos) AS rn FROM a JOIN o ON o.tbl = a.ancestor),
 s AS (SELECT 'countries' AS source, count(DISTINCT name) AS n FROM countries UNION ALL SELECT 'regions', count(DISTINCT name) FROM regions),
 reg AS (SELECT f.tbl, f.col, f.pos, f.kind, f.ancestor AS defined_in, f.depth = 0 AS direct, CASE WHEN f.kind LIKE 'ontology%' AND f.ref <> '' THEN f.ref END AS source FROM f WHERE rn = 1)"""


def _model(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p, key = table(spark, d, "part"), _C("p_partkey").cast("long")
    maker, size = F.expr("substring(p_brand, 1, length(p_brand) - 1)"), _C("p_size")
    makers = p.select(maker.alias("tableName"), F.lit(None).cast("string").alias("tableExtends"), _C("p_type").alias("columnName"), F.lit("string").alias("columnType"), F.lit(None).cast("string").alias("refTable"), key.alias("pos"))
    kind, ref = F.when(size % 3 == 0, "ontology").otherwise("int"), F.when(size % 2 == 0, "countries").otherwise("regions")
    brands = p.select("p_brand", maker, F.concat(F.lit("size "), size), kind, ref, key + 1000000000)
    lists = [table(spark, d, t).select(F.lit(t).alias("source"), "name") for t in ("countries", "regions")]
    return makers.unionAll(brands), lists[0].unionAll(lists[1])


@query(f"{_REGISTRY} SELECT reg.tbl, col, pos, kind, defined_in, direct, reg.source, s.n AS n_allowed FROM reg LEFT JOIN s ON s.source = reg.source")
def registry_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of every table with inherited ones, their lists and sizes."""
    rows, choices = _model(spark, d)
    return G.registry(rows, choices)


@query(f"{_REGISTRY} SELECT source, min(struct_pack(tbl := tbl, pos := pos)).tbl AS tbl, min(struct_pack(tbl := tbl, pos := pos)).pos AS pos FROM reg WHERE source IS NOT NULL GROUP BY source")
def registry_sources(spark: SparkSession, d: str) -> DataFrame:
    """M3: lists that the model needs."""
    return G.required_sources(G.registry(*_model(spark, d)))


@query(f"{_REGISTRY} SELECT tbl, string_agg(concat(col, ':', kind), ';' ORDER BY direct, pos, col, kind) AS columns FROM reg GROUP BY tbl")
def registry_types(spark: SparkSession, d: str) -> DataFrame:
    """Typed columns of every table in order."""
    t = G.table_types(G.registry(*_model(spark, d)))
    return t.select("tbl", F.array_join(F.zip_with("columns", "kinds", lambda a, b: F.concat(a, F.lit(":"), b)), ";").alias("columns"))


@query(f"""{_REGISTRY}, w AS (SELECT DISTINCT p_brand AS tbl, lower(replace(p_type, ' ', '-')) AS field FROM part), k AS (SELECT tbl, regexp_replace(lower(col), '[^a-z0-9]+', '', 'g') AS k, min(struct_pack(pos := pos, col := col, kind := kind, d := defined_in)) AS m FROM reg GROUP BY 1, 2)
 SELECT w.tbl, w.field, k.m.col AS col, k.m.kind AS kind, k.m.d AS defined_in FROM w LEFT JOIN k ON k.tbl = w.tbl AND k.k = regexp_replace(lower(w.field), '[^a-z0-9]+', '', 'g')""")
def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Fields written loosely, found in the table or its ancestors."""
    wanted = table(spark, d, "part").select(_C("p_brand").alias("tbl"), F.lower(F.replace("p_type", F.lit(" "), F.lit("-"))).alias("field")).distinct()
    return G.lookup_columns(wanted, G.registry(*_model(spark, d)))


@query(f"""WITH t AS (SELECT id, unnest([id, name, organisation]) AS tok FROM organisations WHERE regexp_replace(coalesce(id, ''), {TRIM}, '', 'g') <> ''),
 x AS (SELECT regexp_replace(tok, {TRIM}, '', 'g') AS k, min(trim(id)) AS c FROM t WHERE regexp_replace(coalesce(tok, ''), {TRIM}, '', 'g') <> '' GROUP BY 1 HAVING count(DISTINCT trim(id)) = 1),
 y AS (SELECT regexp_replace(lower(tok), '[^a-z0-9]+', '', 'g') AS k, min(trim(id)) AS c FROM t WHERE regexp_replace(lower(coalesce(tok, '')), '[^a-z0-9]+', '', 'g') <> '' GROUP BY 1 HAVING count(DISTINCT trim(id)) = 1),
 r AS (SELECT row_id, regexp_replace(coalesce(publisher, ''), {TRIM}, '', 'g') AS p, CASE WHEN start_year >= 0 THEN CAST(start_year AS VARCHAR) ELSE '' END AS start_year, CASE WHEN data_access_fee THEN 'true' WHEN NOT data_access_fee THEN 'false' ELSE '' END AS fee FROM resources)
 SELECT row_id, start_year, fee AS data_access_fee, coalesce(x.c, y.c, '') AS publisher FROM r LEFT JOIN x ON x.k = p LEFT JOIN y ON y.k = regexp_replace(lower(p), '[^a-z0-9]+', '', 'g')""")
def fixed_tables(spark: SparkSession, d: str) -> DataFrame:
    """Values first, then references against the ids and names of the fixed target table."""
    r = table(spark, d, "resources").select("row_id", *[_C(c).cast("string").alias(c) for c in ("start_year", "data_access_fee", "publisher")])
    orgs = table(spark, d, "organisations").select("id", "name", "organisation")
    kinds = {"resources": {"start_year": "non_negative_int", "data_access_fee": "bool"}, "organisations": {"id": "string"}}
    return V.fix_tables({"resources": r, "organisations": orgs}, kinds, {("resources", "publisher"): ("organisations", "id", ["id", "name", "organisation"])})["resources"]


@query("""WITH old AS (SELECT DISTINCT p_type AS task FROM part), new AS (SELECT DISTINCT p_type AS task, CASE WHEN p_type LIKE 'S%' THEN 'new' ELSE 'own' END AS body FROM part WHERE p_type NOT LIKE 'E%' UNION ALL SELECT 'ADDED', 'new')
 SELECT coalesce(old.task, new.task) AS task, CASE WHEN old.task IS NULL THEN 'new' WHEN new.task IS NULL THEN 'kept' WHEN new.body = 'own' THEN 'same' ELSE 'merged' END AS action, coalesce(new.body, 'own') AS body FROM old FULL OUTER JOIN new ON old.task = new.task""")
def merged_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of two states put together."""
    types = table(spark, d, "part").select(_C("p_type").alias("task")).distinct()
    new = types.filter("task NOT LIKE 'E%'").withColumn("body", F.when(_C("task").startswith("S"), "new").otherwise("own")).unionAll(spark.createDataFrame([("ADDED", "new")], "task string, body string"))
    return V.merge_sections(types.withColumn("body", F.lit("own")), new)
