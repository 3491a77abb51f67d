"""Queries of the text, coercion, array and JSON scalars, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.functions import arrays as A
from studyloom.functions import coercion as N
from studyloom.functions import text as T
from studyloom.operators.chunks import chunk_table
from studyloom.session import spread, table

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
WS = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'"


def _nws(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(replace(coalesce({x}, ''), chr(173), ''), '[‐-—]', '-', 'g'), {WS}, ' ', 'g'))"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """(src, id, text) of all papers and documents."""
    p = table(spark, d, "pdf_text").select(F.lit("paper").alias("src"), _C("paper_id").alias("id"), _C("paper_text").alias("text"))
    return p.unionAll(table(spark, d, "documents").select(F.lit("document"), "doc_id", "text"))


_TEXTS = "(SELECT 'paper' AS src, paper_id AS id, paper_text AS text FROM pdf_text UNION ALL SELECT 'document', doc_id, text FROM documents)"


def _sq(x: str) -> str:
    return f"length(regexp_replace(coalesce({x}, ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def _score(x: str) -> str:
    w = f"regexp_extract_all(coalesce({x}, ''), '[A-Za-z]{{2,}}')"
    return f"CAST({_sq(x)} + 10 * len({w}) + 2 * least(len(list_distinct(list_transform({w}, lambda w: lower(w)))), 2000) AS BIGINT)"


def _ratio(x: str) -> str:
    n = f"length(regexp_replace(coalesce({x}, ''), {TRIM}, '', 'g'))"
    return f"(CASE WHEN {n} > 0 THEN {_sq(x)} / {n} ELSE 0.0 END)"


@query(f"""SELECT doc_id, round({_ratio('text')}, 6) AS alnum_ratio, {_score('text')} AS score,
  (length(regexp_replace(coalesce(text, ''), {TRIM}, '', 'g')) < 3000 OR {_ratio('text')} < 0.35) AS weak FROM documents""")
def text_quality(spark: SparkSession, d: str) -> DataFrame:
    """T2, T3, T4"""
    t = _C("text")
    return table(spark, d, "documents").select(
        "doc_id", F.round(T.alnum_ratio(t), 6).alias("alnum_ratio"), T.quality_score(t).alias("score"), T.needs_fallback(t).alias("weak")
    )


@query(f"""SELECT doc_id, CASE WHEN {_score('description')} > {_score('name')} THEN 'description' ELSE 'name' END AS chosen
 FROM (SELECT row_id AS doc_id, name, description FROM resources)""")
def text_pick_better(spark: SparkSession, d: str) -> DataFrame:
    """The better of two candidate texts, ties to the first."""
    r = table(spark, d, "resources")
    best = T.better_text(F.struct(F.lit("name").alias("w"), F.coalesce("name", F.lit("")).alias("t"))["t"], F.coalesce("description", F.lit("")))
    same = best.eqNullSafe(F.coalesce("description", F.lit(""))) & (T.quality_score(_C("description")) > T.quality_score(_C("name")))
    return r.select(_C("row_id").alias("doc_id"), F.when(same, "description").otherwise("name").alias("chosen"))


@query(f"""SELECT label, count(*) AS n, count(CASE WHEN length(regexp_replace(paper_text, {TRIM}, '', 'g')) < 3000 OR {_ratio('paper_text')} < 0.35 THEN 1 END) AS weak
 FROM (SELECT coalesce(method, 'none') AS label, coalesce(paper_text, '') AS paper_text FROM pdf_text) GROUP BY label""")
def weak_papers(spark: SparkSession, d: str) -> DataFrame:
    """Papers whose text needs another way of reading, by method."""
    p = table(spark, d, "pdf_text").select(F.coalesce("method", F.lit("none")).alias("label"), T.needs_fallback(_C("paper_text")).alias("w"))
    return p.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(_C("w"), 1)).alias("weak"))


@query(f"SELECT src, id, length({_nws('text')}) AS n, md5({_nws('text')}) AS digest FROM {_TEXTS}")
def ws_normalize(spark: SparkSession, d: str) -> DataFrame:
    """T10"""
    clean = T.normalize_ws(_C("text"))
    return _texts(spark, d).select("src", "id", F.length(clean).cast("long").alias("n"), F.md5(F.encode(clean, "utf-8")).alias("digest"))


_DOI = r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"
_BARE = "regexp_replace(regexp_replace(regexp_replace({}, '^(https?://)?(dx\\.)?doi\\.org/', '', 'i'), '^doi:\\s*', '', 'i'), '[.,;:)]+$', '')"


@query(f"""WITH t AS (SELECT src, id, regexp_replace(regexp_extract({_nws('text')}, '\\b({_DOI})\\b', 1), '[.,;:)]+$', '') AS doi FROM {_TEXTS}),
 c AS (SELECT src, id, doi, CASE id % 4 WHEN 0 THEN concat(' doi: ', doi, '.') WHEN 1 THEN concat('HTTPS://dx.doi.org/', doi) WHEN 2 THEN concat(doi, ' and more') ELSE doi END AS cell FROM t WHERE doi <> '')
 SELECT src, id, doi, CASE WHEN id % 4 = 2 THEN trim(cell) ELSE doi END AS ident, CASE WHEN regexp_full_match({_BARE.format('trim(cell)')}, '{_DOI}') THEN concat('https://doi.org/', {_BARE.format('trim(cell)')}) ELSE '' END AS link FROM c""")
def doi_first(spark: SparkSession, d: str) -> DataFrame:
    """The first DOI of every text, read again from the forms in which people write it."""
    doi, k = _C("doi"), _C("id") % 4
    cell = F.when(k == 0, F.concat(F.lit(" doi: "), doi, F.lit("."))).when(k == 1, F.concat(F.lit("HTTPS://dx.doi.org/"), doi)).when(k == 2, F.concat(doi, F.lit(" and more"))).otherwise(doi)
    found = _texts(spark, d).select("src", "id", T.first_doi(T.normalize_ws(_C("text"))).alias("doi")).filter("doi IS NOT NULL")
    return found.select("src", "id", "doi", T.identifier(cell).alias("ident"), N.to_hyperlink(cell, doi=True).alias("link"))


_PART = "(?i)\\b(?:about|approximately|approx\\.?|circa|around|at least)?\\s*(\\d{2,6})\\s*(?:patients|participants)\\s*(?:will be included|included)\\b"


@query(f"""WITH t AS (SELECT src, id, text FROM {_TEXTS} UNION ALL SELECT 'plan', row_id, concat('In all about', chr(160), number_of_participants, ' participants  ', CASE WHEN row_id % 2 = 0 THEN 'will be ' ELSE '' END, 'included.') FROM resources)
 SELECT src, id, CAST(nullif(regexp_extract({_nws('text')}, '{_PART}', 1), '') AS BIGINT) AS n FROM t""")
def participant_hint(spark: SparkSession, d: str) -> DataFrame:
    """Of every paper and document, and of a plan's sentence about every resource."""
    s = F.concat(F.lit("In all about\u00a0"), _C("number_of_participants").cast("string"), F.lit(" participants  "), F.when(_C("row_id") % 2 == 0, "will be ").otherwise(""), F.lit("included."))
    plans = table(spark, d, "resources").select(F.lit("plan").alias("src"), _C("row_id").alias("id"), s.alias("text"))
    return _texts(spark, d).unionAll(plans).select("src", "id", T.participant_hint(_C("text")).alias("n"))


_SAMPLES = ", ".join(f"CASE WHEN regexp_matches(coalesce(text, ''), '(?i)\\b{t.lower()}\\b') THEN '{t}' END" for t in T.SAMPLE_TYPES)


@query(f"SELECT doc_id, array_to_string(list_filter([{_SAMPLES}], lambda x: x IS NOT NULL), ';') AS types FROM documents")
def sample_types(spark: SparkSession, d: str) -> DataFrame:
    """T14"""
    return table(spark, d, "documents").select("doc_id", F.array_join(T.sample_types(_C("text")), ";").alias("types"))


_DS = "(?i)\\b([A-Za-z0-9][A-Za-z0-9''()/\\- ]{0,60}\\bdataset)\\b"


@query(f"""WITH t AS (SELECT src, id, text FROM {_TEXTS} UNION ALL SELECT 'plan', row_id, concat('We used 2 sets: the ', name, ' (NL) dataset, of the ', type, '/', acronym, ' dataset; THE ', upper(name), ' (NL) dataset. A dataset; The 3rd wave of an 1980''s follow-up dataset') FROM resources),
 m AS (SELECT src, id, unnest(regexp_extract_all({_nws('text')}, '{_DS}', 1)) AS p, generate_subscripts(regexp_extract_all({_nws('text')}, '{_DS}', 1), 1) AS i FROM t),
 c AS (SELECT src, id, i, regexp_replace(array_to_string(list_slice(string_split({_nws('p')}, ' '), -6, -1), ' '), '^((and|or|the|a|an|of|for|in)( |$))+', '', 'i') AS h FROM m WHERE length({_nws('p')}) >= 8),
 f AS (SELECT src, id, min(i) AS i, arg_min(h, i) AS h FROM c WHERE lower(h) NOT IN ('dataset', 'data set') AND trim(h) <> '' GROUP BY src, id, lower(trim(h))),
 r AS (SELECT *, row_number() OVER (PARTITION BY src, id ORDER BY i) AS rn FROM f)
 SELECT t.src, t.id, coalesce(h.hints, '') AS hints FROM t LEFT JOIN (SELECT src, id, string_agg(h, ' | ' ORDER BY i) AS hints FROM r WHERE rn <= 3 GROUP BY 1, 2) h ON h.src = t.src AND h.id = t.id""")
def dataset_hint(spark: SparkSession, d: str) -> DataFrame:
    """Of every paper and document, and of a sentence about every resource."""
    s = F.concat(
        F.lit("We used 2 sets: the "), _C("name"), F.lit(" (NL) dataset, of the "), _C("type"), F.lit("/"), _C("acronym"), F.lit(" dataset; THE "), F.upper("name"),
        F.lit(" (NL) dataset. A dataset; The 3rd wave of an 1980's follow-up dataset"),
    )
    none = lambda c: F.coalesce(_C(c), F.lit("")).alias(c)
    r = table(spark, d, "resources").select("row_id", none("name"), none("type"), none("acronym"))
    plans = r.select(F.lit("plan").alias("src"), _C("row_id").alias("id"), s.alias("text"))
    return _texts(spark, d).unionAll(plans).select("src", "id", F.array_join(T.dataset_hints(_C("text")), " | ").alias("hints"))


@query(r"""WITH n AS (SELECT paper_id, regexp_replace(regexp_replace(coalesce(path, ''), '/+$', ''), '^.*/', '') AS f FROM pdf_text),
 s AS (SELECT paper_id, CASE WHEN length(f) > 1 AND strpos(substr(f, 2), '.') > 0 THEN regexp_replace(f, '\.[^.]*$', '') ELSE f END AS f FROM n),
 c AS (SELECT paper_id, regexp_replace(regexp_replace(f, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS f FROM s)
 SELECT paper_id, CASE WHEN f = '' THEN 'paper' ELSE f END AS stem FROM c""")
def safe_stem(spark: SparkSession, d: str) -> DataFrame:
    """T8"""
    return table(spark, d, "pdf_text").select("paper_id", T.safe_stem(_C("path")).alias("stem"))


@query("""SELECT p_partkey, regexp_replace(lower(p_type), '[^a-z0-9]+', '', 'g') AS k,
 regexp_replace(regexp_replace(lower(concat(' ', p_name, ' / ', p_brand, '!')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS snake FROM part""")
def norm_keys(spark: SparkSession, d: str) -> DataFrame:
    """T17, T19"""
    s = F.concat(F.lit(" "), _C("p_name"), F.lit(" / "), _C("p_brand"), F.lit("!"))
    return table(spark, d, "part").select("p_partkey", T.norm_key(_C("p_type")).alias("k"), T.snake_case(s).alias("snake"))


@query(f"""WITH c AS (SELECT row_id, regexp_replace(first_name, {TRIM}, '', 'g') AS f, regexp_replace(prefix, {TRIM}, '', 'g') AS p, regexp_replace(last_name, {TRIM}, '', 'g') AS l FROM contacts)
 SELECT row_id, concat_ws(' ', nullif(f, ''), nullif(p, ''), nullif(l, '')) AS shown FROM c""")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    """T20"""
    return table(spark, d, "contacts").select("row_id", T.display_name(_C("first_name"), _C("prefix"), _C("last_name")).alias("shown"))


_TYPES = ", ".join(f"CASE WHEN regexp_matches(h, '{p}') THEN '{t}' END" for t, p in T.RESOURCE_TYPES.items())
_KNOWN = " ".join(f"WHEN '{k}' THEN '{t}'" for t in T.CANONICAL_TYPES for k in ["".join(c for c in t.lower() if c.isalnum())]) + " WHEN 'catalog' THEN 'Catalogue'"


@query(f"""WITH r AS (SELECT row_id, CASE regexp_replace(lower(coalesce(type, '')), '[^a-z0-9]+', '', 'g') {_KNOWN} END AS own,
  lower(concat_ws(' ', name, acronym, description, keywords)) AS h FROM resources),
 t AS (SELECT row_id, own, list_filter([{_TYPES}], lambda x: x IS NOT NULL) AS told FROM r)
 SELECT row_id, CASE WHEN own IS NOT NULL THEN own WHEN len(told) > 0 THEN array_to_string(told, ';') ELSE 'Other type' END AS types FROM t""")
def resource_types(spark: SparkSession, d: str) -> DataFrame:
    """T21"""
    hay = F.concat_ws(" ", "name", "acronym", "description", "keywords")
    return table(spark, d, "resources").select("row_id", F.array_join(T.resource_types(F.array(F.coalesce("type", F.lit(""))), hay), ";").alias("types"))


@query(f"""WITH t AS (SELECT row_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(name, '')), {TRIM}, '', 'g'), '[-_/]', ' ', 'g'), '\\s+', ' ', 'g')) AS s FROM collection_events),
 m AS (SELECT row_id, s, coalesce(nullif(regexp_extract(s, '\\b(\\d+)\\s*(?:month|months|mo)\\b', 1), ''), nullif(regexp_extract(s, '\\bmonth\\s*(\\d+)\\b', 1), '')) AS mo,
  coalesce(nullif(regexp_extract(s, '\\byear\\s*(\\d+)\\b', 1), ''), nullif(regexp_extract(s, '\\b(\\d+)\\s*year\\b', 1), '')) AS y FROM t)
 SELECT row_id, CASE WHEN s IN ('baseline', 'enrolment', 'enrollment', 't0', 'time 0') THEN 'm0' WHEN mo IS NOT NULL THEN concat('m', CAST(mo AS BIGINT))
  WHEN y IS NOT NULL THEN concat('m', CAST(y AS BIGINT) * 12) ELSE s END AS event FROM m""")
def event_names(spark: SparkSession, d: str) -> DataFrame:
    """T22"""
    return table(spark, d, "collection_events").select("row_id", T.event_name(_C("name")).alias("event"))


_REQ = "available (?:upon|on) request|upon reasonable request|made available on request"
_FEE = "(?i)\\b(fee|cost|charge|payment|paid|pricing|subscription)\\b"


@query(f"""WITH r AS (SELECT row_id, access_rights, data_access_fee, concat(coalesce(description, ''), CASE row_id % 3 WHEN 0 THEN ' The data are available  on request. There is no charge.' WHEN 1 THEN ' Files: upon reasonable request!' ELSE ' Closed.' END) AS s, keywords FROM resources),
 k AS (SELECT row_id, regexp_replace(x, {TRIM}, '', 'g') AS o, i FROM (SELECT row_id, unnest(regexp_split_to_array(coalesce(keywords, ''), '[;,]')) AS x, generate_subscripts(regexp_split_to_array(coalesce(keywords, ''), '[;,]'), 1) AS i FROM r)),
 l AS (SELECT row_id, string_agg(o, '; ' ORDER BY i) AS options FROM (SELECT row_id, arg_min(o, i) AS o, min(i) AS i FROM k WHERE o <> '' AND NOT regexp_matches(o, '(?i)\\b(survival|mortality|outcome|response|recurrence)\\b') GROUP BY row_id, lower(o)) GROUP BY row_id)
 SELECT r.row_id, coalesce(l.options, '') AS options, CASE WHEN trim(coalesce(access_rights, '')) = '' AND regexp_matches({_nws('s')}, '(?i){_REQ}') THEN 'Restricted access' ELSE access_rights END AS rights,
  nullif(substr(trim(regexp_extract({_nws('s')}, '(?i)([^.]*(?:{_REQ})[^.]*\\.)', 1)), 1, 400), '') AS sentence, CASE WHEN data_access_fee AND NOT regexp_matches({_nws('s')}, '{_FEE}') THEN NULL ELSE data_access_fee END AS fee
 FROM r LEFT JOIN l ON l.row_id = r.row_id""")
def linkage_access(spark: SparkSession, d: str) -> DataFrame:
    """Keywords as linkage options, and the terms of access that the description tells."""
    tail = F.when(_C("row_id") % 3 == 0, " The data are available  on request. There is no charge.").when(_C("row_id") % 3 == 1, " Files: upon reasonable request!").otherwise(" Closed.")
    s = F.concat(F.coalesce("description", F.lit("")), tail)
    return table(spark, d, "resources").select(
        "row_id", T.drop_tokens(_C("keywords"), T.OUTCOMES).alias("options"), T.access_rights(_C("access_rights"), s).alias("rights"), T.sentence_with(s).alias("sentence"),
        T.access_fee(_C("data_access_fee"), s).alias("fee"),
    )


_GEO = "regexp_replace(regexp_replace({}, '[()\\[\\]*''’`\".,;/_-]+', ' ', 'g'), '\\s+', ' ', 'g')"


@query(f"""WITH c AS (SELECT 'country' AS lst, code, name, replace(replace(lower(strip_accents(name)), '&', ' and '), '(the)', '') AS k FROM countries
  UNION ALL SELECT 'region', code, name, replace(lower(strip_accents(name)), '&', ' and ') FROM regions)
 SELECT lst, code, name, trim({_GEO.format('k')}) AS k FROM c""")
def geo_keys(spark: SparkSession, d: str) -> DataFrame:
    """T18"""
    c = table(spark, d, "countries").select(F.lit("country").alias("lst"), "code", "name", T.geo_key(_C("name")).alias("k"))
    r = table(spark, d, "regions").select(F.lit("region").alias("lst"), "code", "name", T.geo_key(_C("name"), country=False).alias("k"))
    return c.unionAll(r)


@query("""WITH RECURSIVE t AS (SELECT paper_id, paper_text AS x, length(paper_text) AS n FROM pdf_text WHERE paper_text IS NOT NULL),
 r AS (SELECT paper_id, x, n, 1 AS step, 0 AS s FROM t
  UNION ALL SELECT paper_id, x, n, step + 1, CASE WHEN e - 200 > s THEN e - 200 ELSE e END FROM (
   SELECT paper_id, x, n, step, s, CASE WHEN s + 2000 < n AND edge > s + 1000 THEN edge ELSE least(n, s + 2000) END AS e FROM (
    SELECT *, greatest(CASE WHEN strpos(w, chr(10)) > 0 THEN s + 2000 - strpos(w, chr(10)) ELSE -1 END, CASE WHEN strpos(w, ' ') > 0 THEN s + 2000 - strpos(w, ' ') ELSE -1 END) AS edge
    FROM (SELECT *, reverse(substr(x, s + 1201, 800)) AS w FROM r))) WHERE e < n),
 e AS (SELECT paper_id, step, s, x, CASE WHEN s + 2000 < n AND edge > s + 1000 THEN edge ELSE least(n, s + 2000) END AS e FROM (
    SELECT *, greatest(CASE WHEN strpos(w, chr(10)) > 0 THEN s + 2000 - strpos(w, chr(10)) ELSE -1 END, CASE WHEN strpos(w, ' ') > 0 THEN s + 2000 - strpos(w, ' ') ELSE -1 END) AS edge
    FROM (SELECT *, reverse(substr(x, s + 1201, 800)) AS w FROM r))),
 p AS (SELECT paper_id, step, regexp_replace(substr(x, s + 1, e - s), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS c FROM e)
 SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY step) AS INT) AS idx, CAST(length(c) AS INT) AS n_chars, md5(c) AS digest FROM p WHERE c <> ''""")
def chunk_text(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk of every paper."""
    c = chunk_table(spread(table(spark, d, "pdf_text").select("paper_id", "paper_text")), "paper_id", "paper_text", 2000, 200)
    return c.select("paper_id", "idx", F.length("chunk").alias("n_chars"), F.md5(F.encode("chunk", "utf-8")).alias("digest"))


_HEAD = "(?im)^\\s*(?:\\d{1,2}(?:\\.\\d+)?\\s*)?(?:references?|bibliography|works\\s+cited|literature\\s+cited|reference\\s+list)\\s*:?\\s*$"
_SIGNS = (("\\[\\d{1,3}\\]", 3), ("(?i)\\(\\d{4}[a-z]?\\)", 3), ("(?i)\\b10\\.\\d{4,9}/\\S+", 1), ("(?i)\\b(?:doi|vol\\.?|pp\\.?|et al\\.)\\b", 4), ("\\b\\d{4}\\b", 12))
_TOLD = " + ".join(f"(len(regexp_extract_all(tail, '{sign}')) >= {k})::INT" for sign, k in _SIGNS)


# The k-th heading begins behind the texts before it and the headings before it.
@query(f"""WITH p AS (SELECT paper_id, paper_text AS t, length(paper_text) AS n, regexp_extract_all(paper_text, '{_HEAD}') AS heads, regexp_split_to_array(paper_text, '{_HEAD}') AS gaps FROM pdf_text WHERE paper_text IS NOT NULL),
 h AS (SELECT paper_id, t, n, k, CAST(list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(heads[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS pos FROM (SELECT *, unnest(range(1, len(heads) + 1)) AS k FROM p)),
 g AS (SELECT *, substr(t, pos + 1) AS tail FROM h WHERE pos >= CAST(floor(0.35 * n) AS BIGINT)),
 c AS (SELECT paper_id, min(pos) AS pos FROM g WHERE length(tail) >= 600 AND {_TOLD} >= 2 GROUP BY paper_id),
 r AS (SELECT p.paper_id, p.t, p.n, regexp_replace(substr(p.t, 1, c.pos), '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+$', '') AS kept FROM p LEFT JOIN c ON c.paper_id = p.paper_id),
 o AS (SELECT paper_id, n, CASE WHEN kept IS NULL OR length(kept) < greatest(1000, floor(0.2 * n)) THEN t ELSE kept END AS o FROM r)
 SELECT q.paper_id, length(q.paper_text) AS n_before, length(o.o) AS n_after, md5(o.o) AS digest FROM pdf_text q LEFT JOIN o ON o.paper_id = q.paper_id""")
def reference_strip(spark: SparkSession, d: str) -> DataFrame:
    """Papers without their reference lists."""
    p = spread(table(spark, d, "pdf_text").select("paper_id", "paper_text"))
    return p.select("paper_id", _C("paper_text").alias("before"), T.strip_references(_C("paper_text")).alias("t")).select(
        "paper_id", F.length("before").cast("long").alias("n_before"), F.length("t").cast("long").alias("n_after"), F.md5(F.encode("t", "utf-8")).alias("digest")
    )


@query(f"""WITH t AS (SELECT src, id, regexp_extract(text, '[+-]?[0-9][0-9.,]*', 0) AS raw FROM {_TEXTS} UNION ALL SELECT 'wide', row_id, concat('-000', row_id, '1234567890123456789012') FROM resources
  UNION ALL SELECT 'float', row_id, concat('+', row_id, '.00') FROM resources),
 n AS (SELECT src, id, raw, CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN CAST(CAST(raw AS HUGEINT) AS VARCHAR) WHEN regexp_full_match(raw, '[+-]?[0-9]+\\.0+') THEN CAST(CAST(CAST(raw AS DOUBLE) AS HUGEINT) AS VARCHAR) END AS whole FROM t)
 SELECT src, id, raw, whole, CASE WHEN whole NOT LIKE '-%' THEN whole END AS non_negative FROM n""")
def coerce_int(spark: SparkSession, d: str) -> DataFrame:
    """The first number of every text, and wide and float forms of every resource's."""
    r = table(spark, d, "resources")
    cells = (
        _texts(spark, d).select("src", "id", F.regexp_extract("text", "[+-]?[0-9][0-9.,]*", 0).alias("raw"))
        .unionAll(r.select(F.lit("wide"), "row_id", F.concat(F.lit("-000"), "row_id", F.lit("1234567890123456789012"))))
        .unionAll(r.select(F.lit("float"), "row_id", F.concat(F.lit("+"), "row_id", F.lit(".00"))))
    )
    return cells.select("src", "id", "raw", N.int_text(_C("raw")).alias("whole"), N.int_text(_C("raw"), True).alias("non_negative"))


@query(f"""WITH t AS (SELECT 'resources' AS tbl, row_id, CAST(data_access_fee AS VARCHAR) AS raw FROM resources UNION ALL SELECT 'contacts', row_id, initials FROM contacts
  UNION ALL SELECT 'numbers', row_id, CAST(row_id % 3 AS VARCHAR) FROM contacts UNION ALL SELECT 'words', row_id, CASE WHEN is_lead_organisation THEN ' YES' ELSE 'No ' END FROM organisations),
 b AS (SELECT *, lower(regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g')) AS s FROM t)
 SELECT tbl, row_id, CASE WHEN s IN ('true', '1', 'yes', 'y') THEN 'true' WHEN s IN ('false', '0', 'no', 'n') THEN 'false' ELSE '' END AS b, CASE WHEN s IN ('true', '1', 'yes', 'y') THEN 'true' ELSE 'false' END AS b_or_false FROM b""")
def coerce_bool(spark: SparkSession, d: str) -> DataFrame:
    """N5, N6"""
    contacts = table(spark, d, "contacts")
    cells = (
        table(spark, d, "resources").select(F.lit("resources").alias("tbl"), "row_id", _C("data_access_fee").cast("string").alias("raw"))
        .unionAll(contacts.select(F.lit("contacts"), "row_id", "initials")).unionAll(contacts.select(F.lit("numbers"), "row_id", (_C("row_id") % 3).cast("string")))
        .unionAll(table(spark, d, "organisations").select(F.lit("words"), "row_id", F.when(_C("is_lead_organisation"), " YES").otherwise("No ")))
    )
    return cells.select("tbl", "row_id", N.to_bool(_C("raw")).alias("b"), N.to_bool_or_false(_C("raw")).alias("b_or_false"))


_FORMS = "['%Y-%m-%d', '%Y/%m/%d', '%d/%m/%Y', '%Y-%m-%d %H:%M', '%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M', '%Y/%m/%d %H:%M:%S', '%d/%m/%Y %H:%M', '%d/%m/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S.%f']"


@query(f"""WITH e AS (SELECT 'start' AS field, row_id, start_date AS raw FROM collection_events UNION ALL SELECT 'end', row_id, end_date FROM collection_events UNION ALL SELECT 'issued', row_id, issued FROM resources
  UNION ALL SELECT 'loaded', row_id, strftime(loaded_at, '%Y-%m-%dT%H:%M:%S.%fZ') FROM resources UNION ALL SELECT 'zoned', row_id, strftime(loaded_at, '%Y-%m-%dT%H:%M+02:00') FROM resources
  UNION ALL SELECT 'minutes', row_id, strftime(loaded_at, '%-d/%-m/%Y %H:%M') FROM resources UNION ALL SELECT 'compact', row_id, strftime(loaded_at, '%Y%m%dT%H%M%S') FROM resources UNION ALL SELECT 'dashed', row_id, strftime(loaded_at, '%d-%m-%Y') FROM resources),
 s AS (SELECT field, row_id, regexp_replace(replace(replace(regexp_replace(coalesce(raw, ''), {TRIM}, '', 'g'), 'T', ' '), 'Z', ''), '\\s+', ' ', 'g') AS s FROM e),
 p AS (SELECT field, row_id, coalesce(try_strptime(s, {_FORMS}), CASE WHEN regexp_full_match(s, '\\d{{8}} \\d{{6}}') THEN try_strptime(s, '%Y%m%d %H%M%S') END,
  try_cast(nullif(regexp_extract(s, '^\\d{{4}}-\\d{{2}}-\\d{{2}}(?: \\d{{2}}:\\d{{2}}(?::\\d{{2}})?)?'), '') AS TIMESTAMP)) AS t FROM s)
 SELECT field, row_id, coalesce(strftime(t, '%Y-%m-%d'), '') AS day, coalesce(strftime(t, '%Y-%m-%d %H:%M:%S'), '') AS moment FROM p""")
def coerce_date(spark: SparkSession, d: str) -> DataFrame:
    """Typed dates, and times of loading in further forms."""
    ev, r = table(spark, d, "collection_events"), table(spark, d, "resources")
    cells = ev.select(F.lit("start").alias("field"), "row_id", _C("start_date").alias("raw")).unionAll(ev.select(F.lit("end"), "row_id", "end_date")).unionAll(r.select(F.lit("issued"), "row_id", "issued"))
    forms = {
        "loaded": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "zoned": "yyyy-MM-dd'T'HH:mm'+02:00'", "minutes": "d/M/yyyy HH:mm", "compact": "yyyyMMdd'T'HHmmss", "dashed": "dd-MM-yyyy",
    }
    for name, form in forms.items():
        cells = cells.unionAll(r.select(F.lit(name), "row_id", F.date_format("loaded_at", form)))
    return cells.select("field", "row_id", N.to_date_text(_C("raw")).alias("day"), N.to_datetime_text(_C("raw")).alias("moment"))


@query(f"""SELECT row_id, CASE WHEN regexp_matches(e, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') THEN e ELSE '' END AS email FROM (
  SELECT row_id, regexp_replace(coalesce(CASE WHEN row_id % 4 = 0 THEN replace(email, '@', ' at ') ELSE email END, ''), {TRIM}, '', 'g') AS e FROM contacts)""")
def coerce_email(spark: SparkSession, d: str) -> DataFrame:
    """N7"""
    e = F.when(_C("row_id") % 4 == 0, F.replace(_C("email"), F.lit("@"), F.lit(" at "))).otherwise(_C("email"))
    return table(spark, d, "contacts").select("row_id", N.to_email(e).alias("email"))


@query(f"""WITH w AS (SELECT row_id, CASE row_id % 5 WHEN 0 THEN replace(website, 'https://', 'http://') WHEN 1 THEN replace(website, 'https://', '') WHEN 2 THEN concat(website, ' x') WHEN 3 THEN concat(' ', replace(website, 'https://', 'www.')) ELSE website END AS w FROM resources),
 t AS (SELECT row_id, regexp_replace(coalesce(w, ''), {TRIM}, '', 'g') AS s FROM w)
 SELECT row_id, CASE WHEN regexp_matches(s, '^(?:https?://|www\\.)[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}(?::\\d+)?(?:[/?#]\\S*)?$') THEN CASE WHEN starts_with(s, 'www.') THEN concat('https://', s) ELSE s END
  WHEN regexp_matches(s, '^[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}(?::\\d+)?(?:[/?#]\\S*)?$') THEN concat('https://', s) ELSE '' END AS website FROM t""")
def coerce_hyperlink(spark: SparkSession, d: str) -> DataFrame:
    """N8"""
    w, k = _C("website"), _C("row_id") % 5
    bare = lambda to: F.replace(w, F.lit("https://"), F.lit(to))
    s = F.when(k == 0, bare("http://")).when(k == 1, bare("")).when(k == 2, F.concat(w, F.lit(" x"))).when(k == 3, F.concat(F.lit(" "), bare("www."))).otherwise(w)
    return table(spark, d, "resources").select("row_id", N.to_hyperlink(s).alias("website"))


@query("""SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k, c_mktsegment AS segment, CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS active, '' AS heading, concat('x', c_custkey) AS note FROM customer""")
def typed_table(spark: SparkSession, d: str) -> DataFrame:
    """A table of text normalised by its column types."""
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    raw = table(spark, d, "customer").select(
        "c_custkey", F.concat(_C("c_custkey"), F.lit(".0")).alias("k"), F.concat(F.lit('["'), _C("c_mktsegment"), F.lit('"]')).alias("segment"),
        F.when(_C("c_custkey") % 2 == 0, " YES").otherwise("n").alias("active"), F.lit("About").alias("heading"), F.concat(F.lit(" x"), _C("c_custkey"), F.lit(" ")).alias("note"),
    )
    return N.normalize_table(raw, {"k": "non_negative_int", "segment": "ontology", "active": "bool", "heading": "heading", "note": "text"}, {"segment": segments})


@query("""WITH b AS (SELECT p_brand, list(p_type ORDER BY p_partkey) AS ts FROM part GROUP BY p_brand),
 f AS (SELECT p_brand, list_filter(ts, lambda x, i: list_position(list_transform(ts, lambda y: lower(y)), lower(x)) = i) AS ds FROM b)
 SELECT p_brand, len(ds) AS n, array_to_string(list_transform(list_transform(ds, lambda x: concat(x, ', "', lower(x), '"')), lambda x: concat('"', replace(x, '"', '""'), '"')), ',') AS joined FROM f""")
def array_dedupe_csv(spark: SparkSession, d: str) -> DataFrame:
    """A5, A7"""
    b = table(spark, d, "part").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_type"))), lambda s: s["p_type"]).alias("ts"))
    mixed = F.transform(_C("ts"), lambda x, i: F.when(i % 2 == 1, F.concat(F.lit(" "), x)).otherwise(x))
    ds = F.transform(A.dedupe_ci(mixed), lambda x: F.trim(x))
    quoted = F.transform(ds, lambda x: F.concat(x, F.lit(', "'), F.lower(x), F.lit('"')))
    return b.select("p_brand", F.size(ds).cast("long").alias("n"), A.csv_join(quoted).alias("joined"))


@query("""SELECT p_partkey, concat(p_name, '|', p_brand) AS as_json, concat(p_name, ', x|', p_brand) AS as_csv, concat(p_name, '|', p_brand) AS loose FROM part""")
def array_parse(spark: SparkSession, d: str) -> DataFrame:
    """A1, A2, A4"""
    j = F.to_json(F.array("p_name", F.lit(" "), "p_brand"))
    c = F.concat(F.lit('"'), _C("p_name"), F.lit(', x", '), _C("p_brand"), F.lit(",  ,"))
    loose = F.concat(_C("p_name"), F.lit("; "), _C("p_brand"), F.lit("\n"))
    return table(spark, d, "part").select(
        "p_partkey", F.array_join(A.parse_list(j), "|").alias("as_json"), F.array_join(A.parse_list(c), "|").alias("as_csv"), F.array_join(A.parse_list_loose(loose), "|").alias("loose")
    )


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE '' END AS kept FROM orders""")
def allowed_filter(spark: SparkSession, d: str) -> DataFrame:
    """A3, A11, J15"""
    raw = F.concat(F.lit('["'), F.lower("o_orderpriority"), F.lit('", "unknown", "'), _C("o_orderpriority"), F.lit('"]'))
    return table(spark, d, "orders").select("o_orderkey", A.csv_join(A.allowed_only(A.parse_list(raw), ["1-URGENT", "2-HIGH"])).alias("kept"))


@query("""SELECT user_id, CASE WHEN n % 2 = 0 THEN 'click' ELSE array_to_string(list_sort(es), ';') END AS filled,
  CASE WHEN list_contains(es, 'click') THEN 'click' ELSE concat('none') END AS with_default FROM (SELECT user_id, list_distinct(list(event_type)) AS es, count(*) AS n FROM events GROUP BY user_id)""")
def backfill_default(spark: SparkSession, d: str) -> DataFrame:
    """A21, A22"""
    e = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("es"), F.count(F.lit(1)).alias("n"))
    none = F.array().cast("array<string>")
    filled = A.backfill(F.when(_C("n") % 2 == 0, F.array(F.lit("click"))).otherwise(none), F.array(_C("es"), F.transform(_C("es"), F.upper)))
    has = F.array_contains("es", "click")
    return e.select(
        "user_id", F.array_join(filled, ";").alias("filled"),
        F.array_join(A.add_default(F.when(has, F.array(F.lit("click"))).otherwise(none), "none", ~has), ";").alias("with_default"),
    )


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'x' AS name FROM events""")
def json_lenient(spark: SparkSession, d: str) -> DataFrame:
    """A9, A10, A12, A20"""
    s = F.concat(F.lit('```json\nHere: {"p": '), _C("props"), F.lit(', "list": [1, 2,], "who": {"name": "x"},}\n``` '))
    j = A.lenient_json(s)
    return table(spark, d, "events").select(
        "event_id", F.get_json_object(j, "$.p.k").cast("long").alias("k"), A.scalar_of(F.get_json_object(j, "$.who")).alias("name")
    )


@query("""SELECT section_id, task, coalesce(model, '') <> '' OR coalesce(finish_reason, '') <> '' AS has_meta, CASE WHEN lower(trim(finish_reason)) IN ('', 'null') THEN NULL ELSE finish_reason END AS reason FROM section_results""")
def payload_flags(spark: SparkSession, d: str) -> DataFrame:
    """P1, P2, A15"""
    s = table(spark, d, "section_results")
    return s.select("section_id", "task", A.has_value(_C("model"), _C("finish_reason")).alias("has_meta"), A.truth(_C("finish_reason")).alias("reason"))


