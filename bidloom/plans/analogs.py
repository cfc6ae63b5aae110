"""Queries of award lines, on the star-schema tables that stand for them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.functions import scalars as X
from bidloom.operators import marts
from bidloom.session import table
from bidloom.streaming.feed import windowed_counts

_LINES = """(SELECT l.*, p.p_name, p.p_brand, p.p_partkey AS product, s.s_name, o.o_orderdate FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    lines, part, supplier = (table(spark, d, n) for n in ("lineitem", "part", "supplier"))
    joined = lines.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand"), "l_partkey").join(supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
    return joined.withColumn("product", F.col("l_partkey"))


def product_price_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per product the range and exact median of the cost per unit, its suppliers and tax flags; the 100 products with the most lines."""
    lines = _lines(spark, d)
    c = F.col
    flag = F.when(c("l_tax") > 0, 1).when(c("l_tax") == 0, 0)
    out = marts.group_summary(lines, c("product"), X.unit_cost(c("l_extendedprice"), c("l_quantity")), c("s_name"), c("l_extendedprice"), flag, F.date_format("l_shipdate", "yyyy-MM-dd"))
    return out.withColumns({"amount": F.round("amount", 2)} | {n: F.round(n, 9) for n in ("min_value", "median_value", "max_value")})


_PRICES = f"""SELECT product AS key, COUNT(*) AS lines, ROUND(MIN(v), 9) AS min_value, ROUND(MEDIAN(v), 9) AS median_value, ROUND(MAX(v), 9) AS max_value, STRING_AGG(DISTINCT s_name, ',' ORDER BY s_name) AS names,
  ROUND(SUM(l_extendedprice), 2) AS amount, COUNT(*) FILTER (WHERE l_tax > 0) AS flagged, COUNT(*) FILTER (WHERE l_tax = 0) AS unflagged, COUNT(*) FILTER (WHERE l_tax IS NULL) AS unknown,
  MAX(strftime(l_shipdate, '%Y-%m-%d')) AS latest FROM (SELECT *, CASE WHEN l_extendedprice <> 0 AND l_quantity <> 0 THEN l_extendedprice / l_quantity END AS v FROM {_LINES}) GROUP BY product ORDER BY lines DESC, key LIMIT 100"""


def award_search(spark: SparkSession, d: str) -> DataFrame:
    """Lines that hold every word of a query, newest first."""
    lines = _lines(spark, d).where(marts.text_filter(["p_name", "p_brand", "s_name"], "brand 1 supplier"))
    rows = lines.select("l_orderkey", "l_linenumber", "product", "l_suppkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))
    order = (("shipped", False), ("l_orderkey", True), ("l_linenumber", True), ("product", True), ("l_suppkey", True))
    return marts.page(rows, order, "l_quantity", 200, most=1000)


_AWARDS = f"""SELECT l_orderkey, l_linenumber, product, l_suppkey, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM {_LINES}
  WHERE (p_name ILIKE '%brand%' OR p_brand ILIKE '%brand%' OR s_name ILIKE '%brand%') AND (p_name ILIKE '%1%' OR p_brand ILIKE '%1%' OR s_name ILIKE '%1%')
  AND (p_name ILIKE '%supplier%' OR p_brand ILIKE '%supplier%' OR s_name ILIKE '%supplier%')
  ORDER BY shipped DESC, l_orderkey, l_linenumber, product, l_suppkey, l_quantity LIMIT 200"""


_FOUND = "(p_name ILIKE '%brand%' OR p_brand ILIKE '%brand%' OR s_name ILIKE '%brand%') AND (p_name ILIKE '%1%' OR p_brand ILIKE '%1%' OR s_name ILIKE '%1%')"
_AWARD_COLUMNS = "l_orderkey, l_linenumber, product, l_suppkey, l_quantity"
_AWARD_ROWS = f"""(SELECT {_AWARD_COLUMNS}, strftime(l_shipdate, '%Y-%m-%d') AS published_at, CASE WHEN l_extendedprice <> 0 AND l_quantity <> 0 THEN l_extendedprice / l_quantity END AS unit_cost,
  l_extendedprice AS total_value FROM {_LINES} WHERE {_FOUND})"""


def _awards(spark: SparkSession, d: str) -> DataFrame:
    """Awarded lines that hold the words of a query."""
    c = F.col
    lines = _lines(spark, d).where(marts.text_filter(["p_name", "p_brand", "s_name"], "brand 1"))
    return lines.select(
        "l_orderkey", "l_linenumber", "product", "l_suppkey", "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd").alias("published_at"), X.unit_cost(c("l_extendedprice"), c("l_quantity")).alias("unit_cost"),
        c("l_extendedprice").alias("total_value"), "s_name", "l_tax",
    )


def award_pages_by_sort(spark: SparkSession, d: str) -> DataFrame:
    """The first lines of one search under each of the five orders, with the total."""
    rows = _awards(spark, d)
    keys = ("l_orderkey", "l_linenumber", "product", "l_suppkey")
    pages = [
        marts.counted_page(rows, (*order, *((k, True) for k in keys)), "l_quantity", 60, most=1000).select(F.lit(name).alias("sort"), *keys, "l_quantity", "total")
        for name, order in marts.AWARD_SORTS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), pages)


_SORTED = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{name}' AS sort, {_AWARD_COLUMNS}, (SELECT COUNT(*) FROM {_AWARD_ROWS}) AS total FROM {_AWARD_ROWS} ORDER BY {c} {'ASC' if up else 'DESC'} NULLS LAST, {_AWARD_COLUMNS} LIMIT 60)"
    for name, ((c, up),) in marts.AWARD_SORTS.items()
)


def award_products(spark: SparkSession, d: str) -> DataFrame:
    """The products of the same search, each with the range of its unit costs."""
    c = F.col
    flag = F.when(c("l_tax") > 0, 1).when(c("l_tax") == 0, 0)
    out = marts.group_summary(_awards(spark, d), c("product"), c("unit_cost"), c("s_name"), c("total_value"), flag, c("published_at"))
    return out.select("key", "lines", *[F.round(n, 9).alias(n) for n in ("min_value", "median_value", "max_value")], F.round("amount", 2).alias("amount"), "latest")


_PRODUCTS = f"""SELECT product AS key, COUNT(*) AS lines, ROUND(MIN(unit_cost), 9) AS min_value, ROUND(MEDIAN(unit_cost), 9) AS median_value, ROUND(MAX(unit_cost), 9) AS max_value, ROUND(SUM(total_value), 2) AS amount,
  MAX(published_at) AS latest FROM {_AWARD_ROWS} GROUP BY product ORDER BY lines DESC, key LIMIT 100"""


def award_year(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").where(F.year("l_shipdate") == 1995)
    return lines.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


def customers_by_nation(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("c_acctbal") >= 0).alias("in_credit"))


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """The stream's windowed counts, over all events at once."""
    return windowed_counts(table(spark, d, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


QUERIES = {f.__name__: f for f in (product_price_summary, award_search, award_pages_by_sort, award_products, award_year, customers_by_nation, event_windows)}
ORACLES = {
    "product_price_summary": _PRICES,
    "award_search": _AWARDS,
    "award_pages_by_sort": _SORTED,
    "award_products": _PRODUCTS,
    "award_year": "SELECT l_returnflag, COUNT(*) AS lines, ROUND(SUM(l_extendedprice), 2) AS value FROM lineitem WHERE year(l_shipdate) = 1995 GROUP BY 1",
    "customers_by_nation": "SELECT n_name, COUNT(*) AS customers, COUNT(*) FILTER (WHERE c_acctbal >= 0) AS in_credit FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "event_windows": "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS total FROM events GROUP BY 1, 2",
}
