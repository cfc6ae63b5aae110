"""Queries of the llm subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.llm import canonical, leakage, listmatch, mixing, spans
from bidloom.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    copies = canonical.formatted_copies(table(spark, d, "tenders"), "post_id", canonical.tender_key())
    return copies.select(F.col("kept").alias("kept_post_id"), F.col("copy").alias("copy_post_id"))


def p1_sets(spark: SparkSession, d: str) -> DataFrame:
    """One row per collapsed record with its number of copies."""
    keyed = table(spark, d, "tenders").select(F.col("post_id").alias("id"), canonical.tender_key().alias("key")).where(F.col("key").isNotNull())
    return canonical.counted_keys(keyed).select(F.col("least").alias("kept_post_id"), F.col("rows").alias("copies"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return listmatch.match_products(table(spark, d, "tender_items"), table(spark, d, "product_list"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    leaks = leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return leaks.where((F.col("distance") == 0) & (F.col("longest_run") >= 13)).select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """One row per leaked test item: the documents that hold a passage of it, and those that hold one exactly, not just but for one word."""
    leaks = leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return leaks.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("distance") == 0).alias("exact"))


def p9_corpus(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(*mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_characters(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_sets, p5_found, p8_found, p8_report, p9_corpus, p9_report, p10_found)}


def _canonical_sql() -> str:
    bare = lambda t: f"regexp_replace(lower(url_decode(replace({t}, '+', '%2B'))), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')"
    pair = f"{bare("regexp_extract(p, '^([^=]*)', 1)")} || '=' || {bare("regexp_extract(p, '(?s)^[^=]*=(.*)$', 1)")}"
    query = "string_split_regex(regexp_extract(regexp_replace(url, '#[^?]*$', ''), '(?s)^[^?]*\\?(.*)$', 1), '[&;]')"
    url = f"{bare("regexp_extract(url, '(?s)^([^?#]*)', 1)")} || '?' || array_to_string(list_sort(list_filter(list_transform({query}, lambda p: {pair}), lambda x: x <> '=')), '&')"
    return f"SELECT post_id, {bare('tender_id')} || chr(1) || {url} AS key FROM tenders WHERE tender_id IS NOT NULL AND url IS NOT NULL AND post_id IS NOT NULL"


_RUNS = r"""WITH d AS (SELECT DISTINCT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
  i AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM eval_items WHERE text IS NOT NULL),
  g AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13)),
  x AS (SELECT doc_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13))
  SELECT DISTINCT doc_id, item_id FROM x JOIN g USING (g)"""

# One edit between a window of 13 words and 12, 13 or 14 words of a document: equal without one word of the longer, or of both at one place.
_NEAR = r"""WITH d AS (SELECT DISTINCT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
  i AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM eval_items WHERE text IS NOT NULL),
  a AS (SELECT DISTINCT item_id, w[k:k + 12] AS w FROM (SELECT *, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13)),
  a1 AS (SELECT item_id, p, array_to_string(w[:p - 1] || w[p + 1:], ' ') AS g FROM (SELECT *, unnest(range(1, 14)) AS p FROM a)),
  b12 AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 10)) AS k FROM d)),
  b13 AS (SELECT doc_id, w[k:k + 12] AS w FROM (SELECT *, unnest(range(1, len(w) - 11)) AS k FROM d)),
  b14 AS (SELECT doc_id, w[k:k + 13] AS w FROM (SELECT *, unnest(range(1, len(w) - 12)) AS k FROM d)),
  n AS (SELECT doc_id, item_id FROM (SELECT doc_id, p, array_to_string(w[:p - 1] || w[p + 1:], ' ') AS g FROM (SELECT *, unnest(range(1, 14)) AS p FROM b13)) JOIN a1 USING (p, g)
    UNION SELECT doc_id, item_id FROM b12 JOIN a1 USING (g)
    UNION SELECT doc_id, item_id FROM (SELECT doc_id, array_to_string(w[:p - 1] || w[p + 1:], ' ') AS g FROM (SELECT *, unnest(range(1, 15)) AS p FROM b14)) JOIN (SELECT item_id, array_to_string(w, ' ') AS g FROM a) USING (g)),
  e AS (SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, array_to_string(w, ' ') AS g FROM b13) JOIN (SELECT item_id, array_to_string(w, ' ') AS g FROM a) USING (g))
  SELECT item_id, COUNT(*) AS documents, COUNT(e.doc_id) AS exact FROM n LEFT JOIN e USING (doc_id, item_id) GROUP BY item_id"""

_SHARED = """WITH g AS (SELECT doc_id, k, hash(substr(text, k, 240)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 238)) AS k FROM documents WHERE length(text) >= 240)),
  r AS (SELECT h FROM g GROUP BY h HAVING MIN(doc_id) <> MAX(doc_id)), p AS (SELECT DISTINCT doc_id, k FROM g WHERE h IN (SELECT h FROM r)),
  s AS (SELECT doc_id, k, LAG(k) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM p)
  SELECT doc_id, SUM(CASE WHEN b IS NULL THEN 240 ELSE LEAST(k - b, 240) END)::BIGINT AS shared_chars FROM s GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; matching and mixing have none."""
    key = _canonical_sql()
    return {
        "p1_found": f"SELECT k AS kept_post_id, post_id AS copy_post_id FROM (SELECT post_id, MIN(post_id) OVER (PARTITION BY key) AS k FROM ({key})) WHERE k <> post_id",
        "p1_sets": f"SELECT MIN(post_id) AS kept_post_id, COUNT(*) AS copies FROM ({key}) GROUP BY key",
        "p8_found": _RUNS,
        "p8_report": _NEAR,
        "p10_found": _SHARED,
    }
