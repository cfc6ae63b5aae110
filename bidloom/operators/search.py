"""Full-text search: postings and BM25 over prefix matches."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
WORD = r"[\p{L}\p{M}\p{N}_]+"


def query_tokens(query: str | None) -> list[str]:
    """The words of a query in lower case; whatever else it holds has no meaning."""
    return re.findall(r"\w+", (query or "").lower())


def words(text: Column) -> Column:
    """The words of a text in lower case, with repeats. A null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def postings(documents: DataFrame, key: str, text: Column) -> DataFrame:
    """(term, key, tf, dl): how often a term stands in a document, and the document's length in words.

    Words are counted on the map side, where a document's are together. Rows of one key are one document each.
    """
    own = documents.where(F.col(key).isNotNull()).select(key, words(text).alias("w"))
    counted = own.select(key, F.size("w").alias("dl"), F.explode("w").alias("term")).groupBy("term", key, "dl").agg(F.count(F.lit(1)).cast("int").alias("tf"))
    return counted.select("term", key, "tf", "dl")


def write_index(documents: DataFrame, key: str, text: Column, path: str) -> None:
    """The postings as files that are sorted by term: a prefix then reads the row groups of its range only."""
    postings(documents, key, text).repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(path)


def search(documents: DataFrame, key: str, text: Column, query: str) -> DataFrame:
    """(key, score): documents that hold, for every token of the query, a word that begins with it, with their BM25 score.

    A token's frequency in a document is that of all words it begins; its document frequency counts documents with any such word.
    Only matching words leave the scan. The statistics are one row, a scalar subquery. An empty query matches everything with
    score 0; no text of a query can fail or change anything, since tokens are literals.
    """
    tokens = list(dict.fromkeys(query_tokens(query)))
    own = documents.where(F.col(key).isNotNull())
    if not tokens:
        return own.select(key, F.lit(0.0).alias("score"))
    sized = own.select(key, words(text).alias("w"))
    begun = lambda t: F.size(F.filter("w", lambda x: x.startswith(t)))
    tf = {i: begun(t) for i, t in enumerate(tokens)}
    hits = sized.select(key, F.size("w").alias("dl"), *[n.alias(f"tf{i}") for i, n in tf.items()])
    figures = F.struct(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in tf])
    found = hits
    for i in tf:
        found = found.where(F.col(f"tf{i}") > 0)
    joined = found.withColumn("s", hits.agg(figures.alias("s")).scalar())
    norm = K1 * (1 - B + B * F.col("dl") / F.col("s.avgdl"))
    score = F.lit(0.0)
    for i in tf:
        df, n = F.col(f"s.df{i}"), F.col(f"tf{i}")
        score = score + F.log(1 + (F.col("s.n") - df + 0.5) / (df + 0.5)) * n * (K1 + 1) / (n + norm)
    return joined.select(key, score.alias("score"))


def search_index(index: DataFrame, key: str, query: str, documents: int, average_length: float) -> DataFrame:
    """search over stored postings, given the number of documents and their average length."""
    tokens = list(dict.fromkeys(query_tokens(query)))
    if not tokens:
        return index.select(key).distinct().select(key, F.lit(0.0).alias("score"))
    which = F.filter(F.array(*map(F.lit, tokens)), lambda t: F.col("term").startswith(t))
    some = F.lit(False)
    for t in tokens:
        some = some | F.col("term").startswith(t)
    hits = index.where(some).select(key, "dl", "tf", F.explode(which).alias("token")).groupBy("token", key).agg(F.sum("tf").alias("tf"), F.max("dl").alias("dl"))
    frequency = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    scored = hits.join(F.broadcast(frequency), "token")
    part = F.log(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / average_length))
    return scored.groupBy(key).agg(F.sum(part).alias("score"), F.count(F.lit(1)).alias("k")).where(F.col("k") == len(tokens)).select(key, "score")
