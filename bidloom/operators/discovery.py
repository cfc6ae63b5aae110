"""Union of the places where tenders are found, and the labels that they carry there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.functions.scalars import url_key

# Statuses, the most decisive first; their labels and whether they end a tender.
PRECEDENCE = ("Final_Awarded", "EP0034", "EP0035", "Initial_Awarded", "EP0854", "EP0561", "EP0560", "Opened")
STATUS = {
    "Opened": ("Bids opened", False), "Initial_Awarded": ("Initially awarded", False), "Final_Awarded": ("Awarded", True),
    "EP0034": ("Cancelled", True), "EP0035": ("Re-tendered", True), "EP0854": ("Frozen", False), "EP0561": ("Financial bids opened", False), "EP0560": ("Technical bids opened", False),
}
TERMINAL_SLUGS = ("final-results", "cancelled")


def first_of(labels: Column, precedence: tuple[str, ...]) -> Column:
    """The first of a precedence list that an array of labels holds; else null."""
    return F.get(F.filter(F.array(*map(F.lit, precedence)), lambda p: F.array_contains(labels, p)), F.lit(0))


def is_terminal(slugs: Column, terminal: tuple[str, ...] = TERMINAL_SLUGS) -> Column:
    """1 if any slug ends a tender, else 0."""
    return F.coalesce(F.arrays_overlap(slugs, F.array(*map(F.lit, terminal))), F.lit(False)).cast("int")


def found_tenders(cards: DataFrame, sitemap: DataFrame) -> DataFrame:
    """(url_key, post_id, url, lastmod, via): cards of the grid and entries of the sitemap, matched by their normal address.

    A card's data goes first, the sitemap adds its date. via is grid, sitemap or both. Of several with one address the smallest stands.
    """
    grid = cards.where(F.col("url").isNotNull()).select(url_key(F.col("url")).alias("url_key"), "post_id", "url").groupBy("url_key").agg(F.min(F.struct("post_id", "url")).alias("g"))
    site = sitemap.where(F.col("url").isNotNull()).select(url_key(F.col("url")).alias("url_key"), "url", "lastmod").groupBy("url_key").agg(F.min(F.struct("url", "lastmod")).alias("s"))
    both = grid.join(site, "url_key", "full_outer")
    via = F.when(F.col("s").isNull(), "grid").when(F.col("g").isNull(), "sitemap").otherwise("both")
    return both.select("url_key", F.col("g.post_id").alias("post_id"), F.coalesce("g.url", "s.url").alias("url"), F.col("s.lastmod").alias("lastmod"), via.alias("via"))


def overlay(card: dict[str, Column], detail: dict[str, Column]) -> dict[str, Column]:
    """Per field what the card says unless it is null or '', else what the detail page says."""
    return {f: F.coalesce(F.nullif(card[f], F.lit("")), detail[f]) if f in card else detail[f] for f in {**detail, **card}}


def needs_fetch(known: dict[str, Column], card: dict[str, Column]) -> Column:
    """Whether a tender's detail page has to be read: unknown, never read, or moved (address date, deadline, slugs), or not at its end."""
    moved = [~known[f].eqNullSafe(card[f]) for f in ("lastmod", "submission_deadline", "status_slugs") if f in card]
    return reduce(lambda a, b: a | b, moved, known["post_id"].isNull() | known["detail_fetched_at"].isNull() | (F.coalesce(known["is_terminal"], F.lit(0)) == 0))


def frozen(force: bool, fetched: Column, same: Column, awarded: Column, has_award: Column) -> Column:
    """Whether a tender can be skipped: not forced, read before, unchanged, and with its award if it is awarded."""
    return F.lit(not force) & fetched.isNotNull() & same & (~awarded | has_award)


def merged_passes(passes: DataFrame) -> DataFrame:
    """(post_id, year, labels, status, subcategory, title): one row per tender of all crawl passes.

    passes: (post_id, year, pass_no, ok, label, subcategory, title), one row per tender and pass. A year of which any pass failed counts for nothing. labels is the
    union; the subcategory is the last within a year, the first that isn't null across years.
    """
    broken = passes.where(~F.coalesce(F.col("ok"), F.lit(False))).select("year").distinct()
    good = passes.where(F.col("post_id").isNotNull()).join(broken, "year", "left_anti")
    yearly = good.groupBy("post_id", "year").agg(
        F.collect_set("label").alias("labels"), F.max_by("subcategory", F.when(F.col("subcategory").isNotNull(), F.col("pass_no"))).alias("subcategory"), F.min_by("title", "pass_no").alias("title"),
    )
    merged = yearly.groupBy("post_id").agg(
        F.min("year").alias("year"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"),
        F.min_by("subcategory", F.when(F.col("subcategory").isNotNull(), F.col("year"))).alias("subcategory"), F.min_by("title", "year").alias("title"),
    )
    return merged.select("post_id", "year", "labels", first_of(F.col("labels"), PRECEDENCE).alias("status"), "subcategory", "title")


def labelled(tenders: DataFrame, as_of: str) -> DataFrame:
    """Adds status_label and is_terminal: of the status, else Open while the deadline (ISO text) isn't over, else Closed."""
    label = F.create_map(*[F.lit(x) for code, (name, _) in STATUS.items() for x in (code, name)])[F.col("status")]
    ends = F.col("status").isin([code for code, (_, end) in STATUS.items() if end])
    by_date = F.when(F.col("deadline") >= as_of, "Open").otherwise("Closed")
    return tenders.withColumns({"status_label": F.coalesce(label, by_date), "is_terminal": F.coalesce(ends, F.lit(False)).cast("int")})


def work_order(tenders: DataFrame, limit: int | None = None) -> DataFrame:
    """Tenders in the order in which they are worth a visit: awarded first, then later years, then greater keys."""
    ordered = tenders.orderBy(F.col("awarded").desc_nulls_last(), F.col("year").desc_nulls_last(), F.col("post_id").desc_nulls_last())
    return ordered if limit is None else ordered.limit(limit)
