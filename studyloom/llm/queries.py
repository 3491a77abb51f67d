"""Queries of the training-text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm import leaks, mapping, mixing, names, ocr, pieces, quality
from studyloom.session import cut, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_pairs(table(spark, d, "organisations"), table(spark, d, "contacts")).distinct()


def p2_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(table(spark, d, "organisations"), table(spark, d, "contacts"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = pieces.long_paragraphs(table(spark, d, "pdf_text"), "paper_id", "paper_text")
    return found.select(F.col("item").alias("paper_id"), "para_no").distinct()


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_cells(table(spark, d, "pdf_text"), "paper_id", "paper_text").withColumnRenamed("item", "paper_id")


def _places(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, d, t) for t in ("resources", "choice_matches", "countries", "regions"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = mapping.mapped_places(*_places(spark, d))
    return found.select("tbl", "row_id", "field", "pos", F.coalesce("code", F.lit("UNMATCHED")).alias("code")).distinct()


def p5_matches(spark: SparkSession, d: str) -> DataFrame:
    return mapping.corrected_matches(*_places(spark, d))


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values without an entry, with their number of rows."""
    found = mapping.mapped_places(*_places(spark, d)).filter("code IS NULL")
    return found.groupBy("lst", "val").agg(F.count(F.lit(1)).alias("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return ocr.damage(table(spark, d, "pdf_text")).distinct()


def p6_text(spark: SparkSession, d: str) -> DataFrame:
    return ocr.repaired(table(spark, d, "pdf_text"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_pairs(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """Also passages with up to two words changed in a window of 16."""
    return leaks.leaked_pairs(table(spark, d, "documents"), table(spark, d, "eval_items"), window=16, max_edits=2)


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.short_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    tokens = cut(mixing.with_tokens(table(spark, d, "documents")))
    return mixing.mix(tokens, mixing.plan(tokens, table(spark, d, "mix_targets")))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    tokens = cut(mixing.with_tokens(table(spark, d, "documents")))
    return mixing.report(tokens, mixing.plan(tokens, table(spark, d, "mix_targets")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(table(spark, d, "documents"))


def p10_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_entities, p4_found, p4_pieces, p5_found, p5_matches, p5_unmatched, p6_found, p6_text, p8_found, p8_documents, p8_near, p8_items, p9_found, p9_mix, p9_report, p10_found, p10_stats)}

_CUT = "[-‐­][ \\t\\f]*\\r?\\n\\s*"
_MARK = "chr(57344)"
_FLAT = f"strip_accents(lower(replace(regexp_replace(text, '{_CUT}', {_MARK}, 'g'), chr(173), '')))"
# A mark stays only between two letters or digits: there a word is cut.
_MARKED = f"regexp_replace(regexp_replace({_FLAT}, '(^|[^\\p{{L}}\\p{{N}}\\x{{E000}}])\\x{{E000}}', '\\1 ', 'g'), '\\x{{E000}}($|[^\\p{{L}}\\p{{N}}])', ' \\1', 'g')"
_JOINED = f"regexp_extract_all(replace({_MARKED}, {_MARK}, ''), '[\\p{{L}}\\p{{N}}]+')"
_APART = f"regexp_extract_all({_MARKED}, '[\\p{{L}}\\p{{N}}]+')"
_TOKENS = f"regexp_extract_all({_MARKED}, '[\\p{{L}}\\p{{N}}]+|\\x{{E000}}')"
# Runs of twelve words of items, and of both readings of documents with the place of their first word in the joined one.
_LEAKS = f"""WITH i AS (SELECT item_id, {_JOINED} AS w FROM eval_items WHERE text IS NOT NULL),
 ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i)),
 few AS (SELECT g FROM ig GROUP BY g HAVING count(*) <= 3),
 t AS (SELECT row_number() OVER () AS n, doc_id, text, strpos({_MARKED}, {_MARK}) > 0 AS is_cut FROM documents WHERE text IS NOT NULL),
 j AS (SELECT doc_id, k AS place, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM (SELECT doc_id, {_JOINED} AS w FROM t))),
 tok AS (SELECT n, doc_id, unnest({_TOKENS}) AS x, generate_subscripts({_TOKENS}, 1) AS p FROM t WHERE is_cut),
 pl AS (SELECT n, doc_id, x, row_number() OVER (PARTITION BY n ORDER BY p) AS o, p FROM tok WHERE x <> {_MARK}),
 ap AS (SELECT n, doc_id, o - (p - o) AS place, array_to_string(list(x) OVER (PARTITION BY n ORDER BY o ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING), ' ') AS g, count(*) OVER (PARTITION BY n ORDER BY o ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS c FROM pl),
 dg AS (SELECT doc_id, place, g FROM j UNION ALL SELECT doc_id, place, g FROM ap WHERE c = 12),
 hit AS (SELECT doc_id, item_id, place FROM dg JOIN ig USING (g) WHERE g IN (SELECT g FROM few)),
 pairs AS (SELECT doc_id, item_id, count(DISTINCT place) AS n_windows, CAST(min(place) AS BIGINT) AS first_pos, CAST(max(place) AS BIGINT) AS last_pos, CAST(0 AS INT) AS least_edits FROM hit GROUP BY 1, 2)"""

#: Queries that SQL expresses on whole tables; the others are tested against brute force, round trips and held-out labels.
SQL: dict[str, str] = {
    "p4_found": """WITH p AS (SELECT paper_id, list_filter(list_transform(regexp_split_to_array(paper_text, '\\n[ \\t\\r\\f]*\\n'),
  lambda x: regexp_replace(x, '^[ \\t\\r\\f\\n]+|[ \\t\\r\\f\\n]+$', '', 'g')), lambda x: x <> '') AS ps FROM pdf_text WHERE paper_text IS NOT NULL)
 SELECT paper_id, CAST(i AS BIGINT) AS para_no FROM (SELECT paper_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p) WHERE length(ps[i]) > 4000""",
    "p8_found": f"{_LEAKS} SELECT doc_id, item_id FROM pairs",
    "p8_documents": f"{_LEAKS} SELECT * FROM pairs",
    "p8_items": f"{_LEAKS} SELECT e.item_id, coalesce(p.n, 0) AS n_docs, CAST(coalesce(p.w, 0) AS BIGINT) AS n_windows FROM (SELECT DISTINCT item_id FROM eval_items) e LEFT JOIN (SELECT item_id, count(*) AS n, sum(n_windows) AS w FROM pairs GROUP BY 1) p ON p.item_id = e.item_id",
    # No case is so close that characters and tokens differ.
    "p9_found": """WITH t AS (SELECT source, sum(length(text)) AS n FROM documents GROUP BY source), a AS (SELECT sum(n) AS n FROM t)
 SELECT m.source FROM mix_targets m LEFT JOIN t ON t.source = m.source, a WHERE coalesce(t.n, 0) * m.max_repeats < m.target_share * a.n""",
}
