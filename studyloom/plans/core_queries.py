"""Queries of the general data-preparation problems (1, 3, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studyloom.operators import multivalue, nested, orphans
from studyloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.section_entries(table(spark, d, "section_results")).distinct()


def p1_external_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return nested.section_tables(table(spark, d, "section_results"))["external_identifiers"]


def p1_subpopulations(spark: SparkSession, d: str) -> DataFrame:
    return nested.section_tables(table(spark, d, "section_results"))["subpopulations"]


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    return nested.section_tables(table(spark, d, "section_results"))["counts"]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return multivalue.catalogue_values(table(spark, d, "resources"), table(spark, d, "collection_events")).distinct()


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    refs = orphans.catalogue_references(*(table(spark, d, t) for t in ("subpopulation_counts", "collection_events", "resources")))
    targets = orphans.catalogue_targets(*(table(spark, d, t) for t in ("subpopulations", "organisations", "contacts")))
    return orphans.orphans(refs, targets)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_external_identifiers, p1_subpopulations, p1_counts, p3_found, p7_found, p7_report)}

_EDGE = r"'^[\s\x0b\p{Z}]+|[\s\x0b\p{Z}]+$'"
_Q = r'"(?:[^"]|"")*"'
_HEAD = r"(?:[,;|•\n\r\t]|\s/ )"


def _values(src: str) -> str:
    """CTEs up to ``vals`` (tbl, row_id, field, x, pos, val) of the values packed in the cells of src (tbl, row_id, field, x, cell):
    cells are cut into quoted spans and single letters, each told whether it parts two values."""
    return f"""cells AS (SELECT row_number() OVER () AS n, tbl, row_id, field, x, regexp_replace(cell, {_EDGE}, '', 'g') AS t FROM ({src}) WHERE cell IS NOT NULL),
 kinds AS (SELECT *, regexp_full_match(t, '(?s)\\[.*\\]') AS lit FROM cells),
 toks AS (SELECT n, lit, unnest(k) AS k, generate_subscripts(k, 1) AS i FROM (SELECT n, lit, CASE WHEN lit THEN regexp_extract_all(substr(t, 2, length(t) - 2), '(?s)''(?:[^''\\\\]|\\\\.)*''|"(?:[^"\\\\]|\\\\.)*"|.')
   ELSE regexp_extract_all(t, '(?s)(?:^|{_HEAD})[ \\x{{a0}}]*{_Q}|.') END AS k FROM kinds)),
 told AS (SELECT *, length(k) > 1 AS q, CASE WHEN lit OR length(k) = 1 THEN '' ELSE regexp_extract(k, '(?s)^({_HEAD}?[ \\x{{a0}}]*)"', 1) END AS head, right(lag(k) OVER w, 1) AS l, left(lead(k) OVER w, 1) AS r FROM toks WINDOW w AS (PARTITION BY n ORDER BY i)),
 seps AS (SELECT *, CASE WHEN q THEN regexp_matches(head, '^[;|•\\n\\r\\t]|^\\s/ ') ELSE regexp_matches(k, '^[;|•\\n\\r\\t]$') OR (k = '/' AND regexp_matches(coalesce(l, ''), '^\\s$') AND regexp_matches(coalesce(r, ''), '^\\s$')) END AS hard,
   CASE WHEN q THEN left(head, 1) = ',' ELSE k = ',' END AS soft FROM told),
 modes AS (SELECT *, bool_or(hard AND NOT lit) OVER (PARTITION BY n) AS strong FROM seps),
 cuts AS (SELECT *, CASE WHEN lit THEN NOT q AND k = ',' WHEN strong THEN hard ELSE soft END AS parts FROM modes),
 texts AS (SELECT n, i, lit, q, sum(parts::INT) OVER (PARTITION BY n ORDER BY i) AS g, CASE WHEN NOT q THEN CASE WHEN parts THEN '' ELSE k END
   WHEN lit THEN coalesce(json_extract_string(try_cast(concat('["', CASE WHEN k[1] = '"' THEN substr(k, 2, length(k) - 2) ELSE regexp_replace(regexp_replace(substr(k, 2, length(k) - 2), '\\\\''', '''', 'g'), '(^|[^\\\\])"', '\\1\\\\"', 'g') END, '"]') AS JSON), '$[0]'), substr(k, 2, length(k) - 2))
   ELSE concat(CASE WHEN parts THEN '' ELSE head END, replace(substr(k, length(head) + 2, length(k) - length(head) - 2), '""', '"')) END AS s FROM cuts),
 groups AS (SELECT n, g, bool_or(lit) AND NOT bool_or(q) AS bare, regexp_replace(string_agg(s, '' ORDER BY i), {_EDGE}, '', 'g') AS val FROM texts GROUP BY n, g),
 vals AS (SELECT c.tbl, c.row_id, c.field, c.x, row_number() OVER (PARTITION BY c.n ORDER BY g) AS pos, val FROM groups v JOIN cells c ON c.n = v.n WHERE val <> '' AND NOT (bare AND lower(val) IN ('null', 'none')))"""


_PACKED = """SELECT 'resources' AS tbl, row_id, 'keywords' AS field, NULL AS x, keywords AS cell FROM resources UNION ALL SELECT 'resources', row_id, 'countries', NULL, countries FROM resources
  UNION ALL SELECT 'collection_events', row_id, 'subpopulations', NULL, subpopulations FROM collection_events"""
_EVENTS = "SELECT 'collection_events' AS tbl, row_id, 'subpopulations' AS field, struct_pack(r := resource, l := loaded_at) AS x, subpopulations AS cell FROM collection_events"
_KEY = "lower(regexp_replace(regexp_replace({}, '[\\s\\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g'))"
_FILLED = "regexp_matches(coalesce({}, ''), '[^\\s\\p{{Z}}]')"
_ORPHANS = f"""WITH {_values(_EVENTS)}, t AS (
  SELECT concat('s|', {_KEY.format('resource')}, '|', {_KEY.format('name')}) AS k, loaded_at AS a, deleted_at AS z FROM subpopulations WHERE resource IS NOT NULL AND {_FILLED.format('name')}
  UNION ALL SELECT concat('o|', {_KEY.format('id')}), loaded_at, deleted_at FROM organisations WHERE {_FILLED.format('id')}
  UNION ALL SELECT concat('c|', {_KEY.format('contact_code')}), loaded_at, deleted_at FROM contacts WHERE {_FILLED.format('contact_code')}),
 r AS (SELECT 'subpopulation_counts' AS tbl, row_id, 'subpopulation' AS field, CAST(1 AS BIGINT) AS pos, CASE WHEN resource IS NOT NULL THEN concat('s|', {_KEY.format('resource')}, '|', {_KEY.format('subpopulation')}) END AS k, loaded_at AS l FROM subpopulation_counts WHERE {_FILLED.format('subpopulation')}
  UNION ALL SELECT tbl, row_id, field, pos, CASE WHEN x.r IS NOT NULL THEN concat('s|', {_KEY.format('x.r')}, '|', {_KEY.format('val')}) END, x.l FROM vals
  UNION ALL SELECT 'resources', row_id, 'contact_point', 1, concat('c|', {_KEY.format('contact_point')}), loaded_at FROM resources WHERE {_FILLED.format('contact_point')}
  UNION ALL SELECT 'resources', row_id, 'publisher', 1, concat('o|', {_KEY.format('publisher')}), loaded_at FROM resources WHERE {_FILLED.format('publisher')}),
 j AS (SELECT r.tbl, r.row_id, r.field, r.pos, r.l, count(t.k) AS n, count(CASE WHEN t.a <= r.l THEN 1 END) AS seen, count(CASE WHEN t.a <= r.l AND (t.z IS NULL OR r.l < t.z) THEN 1 END) AS live
  FROM r LEFT JOIN t ON t.k = r.k GROUP BY ALL),
 f AS (SELECT tbl, row_id, field, pos, CASE WHEN n = 0 THEN 'missing' WHEN seen > 0 THEN 'deleted' ELSE 'late' END AS reason, strftime(l, '%Y-%m') AS period FROM j WHERE live = 0)"""

SQL: dict[str, str] = {
    "p3_found": f"WITH {_values(_PACKED)} SELECT DISTINCT tbl, row_id, field, pos, val FROM vals",
    "p7_found": f"{_ORPHANS} SELECT DISTINCT * FROM f",
    "p7_report": f"{_ORPHANS} SELECT tbl, field, period, reason, count(*) AS n_references, count(DISTINCT row_id) AS n_rows FROM f GROUP BY ALL",
}


def _json(x: str) -> str:
    """JSON of a text, stray trailing commas allowed; null if it is none."""
    return f"coalesce(try_cast({x} AS JSON), try_cast(regexp_replace({x}, ',+(\\s*[}}\\]])', '\\1', 'g') AS JSON))"


def _bare(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[\\s\\x{{FEFF}}]+|[\\s\\x{{FEFF}}]+$', '', 'g'), '^\\s*```\\w*\\s*|\\s*```\\s*$', '', 'g')"


def _pick(obj: str, key: str) -> str:
    """Value of the first key of an object with these letters, a null one only if there is no other."""
    keys = f"list_filter(json_keys({obj}), lambda k: regexp_replace(lower(k), '[^\\p{{L}}\\p{{N}}]', '', 'g') = '{key}')"
    full = f"list_filter({keys}, lambda k: json_type(json_extract({obj}, concat('$.\"', k, '\"'))) <> 'NULL')"
    return f"json_extract({obj}, '$.\"' || coalesce({full}[1], {keys}[1]) || '\"')"


def _list(x: str) -> str:
    """A list as it is; a lone object as a list of one; a list written as text."""
    return f"""CASE json_type({x}) WHEN 'ARRAY' THEN {x} WHEN 'OBJECT' THEN json_array({x})
   WHEN 'VARCHAR' THEN CASE WHEN json_extract_string({x}, '$') LIKE '[%' AND json_type({_json(f"json_extract_string({x}, '$')")}) = 'ARRAY' THEN {_json(f"json_extract_string({x}, '$')")} END END"""


_SOME = "(SELECT coalesce(bool_or(q.type NOT IN ('OBJECT', 'ARRAY', 'NULL') AND (q.type <> 'VARCHAR' OR regexp_matches(json_extract_string(q.atom, '$'), '[^\\s\\p{Z}]'))), false) FROM json_tree(e) q)"
_ENTRIES = f"""WITH a0 AS (SELECT section_id, resource, task, {_bare('payload')} AS t FROM section_results WHERE task IN ('task_overview', 'task_subpopulations') AND payload IS NOT NULL),
 a1 AS (SELECT * EXCLUDE (t), CASE WHEN json_type({_json('t')}) = 'VARCHAR' THEN {_bare(f"json_extract_string({_json('t')}, '$')")} ELSE t END AS t FROM a0),
 a2 AS (SELECT * EXCLUDE (t), CASE WHEN json_type({_json('t')}) = 'VARCHAR' THEN {_bare(f"json_extract_string({_json('t')}, '$')")} ELSE t END AS t FROM a1),
 a3 AS (SELECT *, {_json('t')} AS whole, {_json("regexp_extract(t, '(?s)[{].*[}]')")} AS held, {_json("regexp_extract(t, '(?s)" + '"(?:[^"\\\\]|\\\\.)*"' + "')")} AS said FROM a2),
 a4 AS (SELECT *, CASE WHEN json_type(whole) IS NULL AND json_type(held) IS NULL AND json_type(said) = 'VARCHAR' THEN {_json("json_extract_string(said, '$')")} END AS told FROM a3),
 a5 AS (SELECT section_id, resource, task, CASE WHEN task = 'task_overview' THEN 'externalidentifiers' ELSE 'subpopulations' END AS wanted, CASE WHEN json_type(whole) = 'OBJECT' THEN whole WHEN json_type(held) = 'OBJECT' THEN held WHEN json_type(told) = 'OBJECT' THEN told END AS o FROM a4),
 a6 AS (SELECT * FROM a5 WHERE o IS NOT NULL),
 own AS (SELECT section_id, resource, wanted, coalesce({_pick('o', 'externalidentifiers')}, 'null'::JSON) AS x, coalesce({_pick('o', 'subpopulations')}, 'null'::JSON) AS s,
   list_contains(list_transform(json_keys(o), lambda k: regexp_replace(lower(k), '[^\\p{{L}}\\p{{N}}]', '', 'g')), wanted) AS has, o FROM a6),
 outer_ AS (SELECT own.*, CASE WHEN NOT has THEN (SELECT min(c.value) FROM json_each(o) c WHERE c.type = 'OBJECT' AND list_contains(list_transform(json_keys(c.value), lambda k: regexp_replace(lower(k), '[^\\p{{L}}\\p{{N}}]', '', 'g')), wanted)) END AS w FROM own),
 lists AS (SELECT section_id, resource, wanted, CASE WHEN wanted = 'subpopulations' THEN CASE WHEN has THEN s ELSE {_pick('w', 'subpopulations')} END ELSE CASE WHEN has THEN x ELSE {_pick('w', 'externalidentifiers')} END END AS v FROM outer_),
 arrays AS (SELECT section_id, resource, wanted, {_list('v')} AS v FROM lists),
 entries AS (SELECT section_id, resource, wanted, CAST(i + 1 AS BIGINT) AS outer_pos, json_extract(v, concat('$[', i, ']')) AS e FROM (SELECT *, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i FROM arrays WHERE v IS NOT NULL)),
 kept AS (SELECT * FROM entries WHERE json_type(e) = 'OBJECT' AND {_SOME}),
 inner_ AS (SELECT section_id, resource, outer_pos, p, {_list('c')} AS v FROM (SELECT section_id, resource, outer_pos, e AS p, {_pick('e', 'counts')} AS c FROM kept WHERE wanted = 'subpopulations')),
 subs AS (SELECT section_id, resource, outer_pos, p, CAST(i + 1 AS BIGINT) AS inner_pos, json_extract(v, concat('$[', i, ']')) AS e FROM (SELECT *, unnest(range(CAST(json_array_length(v) AS BIGINT))) AS i FROM inner_ WHERE v IS NOT NULL)),
 counts AS (SELECT * FROM subs WHERE json_type(e) = 'OBJECT' AND {_SOME})"""


def _field(obj: str, key: str) -> str:
    """A value as text: whole numbers without a point."""
    v = _pick(obj, key)
    return f"""CASE json_type({v}) WHEN 'NULL' THEN NULL WHEN 'DOUBLE' THEN CASE WHEN CAST({v} AS DOUBLE) = floor(CAST({v} AS DOUBLE)) THEN CAST(CAST(CAST({v} AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE json_extract_string({v}, '$') END ELSE json_extract_string({v}, '$') END"""


SQL |= {
    "p1_found": f"""{_ENTRIES} SELECT DISTINCT section_id, CASE wanted WHEN 'subpopulations' THEN wanted ELSE 'external_identifiers' END AS list_name, outer_pos, CAST(0 AS BIGINT) AS inner_pos FROM kept
  UNION SELECT DISTINCT section_id, 'counts', outer_pos, inner_pos FROM counts""",
    "p1_external_identifiers": f"{_ENTRIES} SELECT section_id, resource, CAST(outer_pos AS INT) AS outer_pos, {_field('e', 'identifier')} AS identifier, {_field('e', 'type')} AS type, {_field('e', 'typeother')} AS type_other FROM kept WHERE wanted = 'externalidentifiers'",
    "p1_counts": f"""{_ENTRIES} SELECT section_id, resource, CAST(outer_pos AS INT) AS outer_pos, CAST(inner_pos AS INT) AS inner_pos, {_field('p', 'name')} AS parent_name, {_field('p', 'pid')} AS parent_pid, {_field('e', 'agegroup')} AS age_group,
  {_field('e', 'ntotal')} AS n_total, {_field('e', 'nfemale')} AS n_female, {_field('e', 'nmale')} AS n_male FROM counts""",
}
