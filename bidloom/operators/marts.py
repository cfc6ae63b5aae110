"""Views and rollups over the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTRIES = ("SA", "JO")


def is_open() -> Column:
    """A tender that isn't at its end and whose deadline, if known, hasn't passed."""
    return (F.col("is_terminal") == 0) & (F.col("days_to_deadline").isNull() | (F.col("days_to_deadline") >= 0))


def country_of() -> Column:
    return F.coalesce(F.col("country"), F.lit("SA"))


def current_files(attachments: DataFrame) -> DataFrame:
    """Current attachments, each id once."""
    return attachments.where(F.col("is_current") == 1).select(F.col("id").alias("attachment_id"), F.col("filename"), F.col("url").alias("file_url")).dropDuplicates(["attachment_id"])


def current_items(items: DataFrame, attachments: DataFrame, tenders: DataFrame) -> DataFrame:
    """Items of current files with their tender: (id, post_id, tender_id, nupco_code, description, uom, qty, category_guess, is_accessory, attachment_id, filename, title_en, status_label,
    submission_ts, opening_ts, country, is_terminal, days_to_deadline). Redelivered rows count once; rows without a tender or current file are left out.
    """
    files = current_files(attachments)
    own = items.select("id", "attachment_id", "post_id", "nupco_code", "description", "uom", "qty", F.col("category_guess").alias("item_category"), "is_accessory")
    # Lines of retired files go before the widest step, the one that tells redelivered rows.
    own = own.join(files.select("attachment_id"), "attachment_id", "left_semi").dropDuplicates(["id"])
    heads = tenders.select("post_id", "tender_id", "title_en", "status_label", "submission_ts", "opening_ts", country_of().alias("country"), "is_terminal", "days_to_deadline")
    return own.join(files, "attachment_id").join(heads, "post_id").select(
        "id", "post_id", "tender_id", "nupco_code", "description", "uom", "qty", F.col("item_category").alias("category_guess"), "is_accessory", "attachment_id", "filename", "title_en",
        "status_label", "submission_ts", "opening_ts", "country", "is_terminal", "days_to_deadline",
    )


def catalogue(current: DataFrame) -> DataFrame:
    """One row per material code of current items: description (the first), tender_count, line_count, total_qty, category, latest_deadline, tender_ids (sorted, comma-separated).

    A code of any share of all rows combines on the map side; its list of tenders is the set that the result asks for.
    """
    own = current.where(F.col("nupco_code").isNotNull() & (F.col("nupco_code") != ""))
    return own.groupBy("nupco_code").agg(
        F.min("description").alias("description"), F.size(F.collect_set("tender_id")).cast("long").alias("tender_count"), F.count(F.lit(1)).alias("line_count"),
        F.sum(F.coalesce(F.col("qty"), F.lit(0.0))).alias("total_qty"), F.max("category_guess").alias("category"), F.max("submission_ts").alias("latest_deadline"),
        F.array_join(F.array_sort(F.collect_set("tender_id")), ",").alias("tender_ids"),
    )


def rollup(tenders: DataFrame, items: DataFrame, attachments: DataFrame) -> DataFrame:
    """(post_id, item_count, total_qty, attachment_count): counts over current files, 0 where there are none; total_qty is null then."""
    files = attachments.where(F.col("is_current") == 1).select(F.col("id").alias("attachment_id"), "post_id").dropDuplicates(["attachment_id"])
    lines = items.select("id", "attachment_id", "qty").dropDuplicates(["id"]).join(files, "attachment_id").groupBy("post_id").agg(F.count(F.lit(1)).alias("item_count"), F.sum("qty").alias("total_qty"))
    counts = files.groupBy("post_id").agg(F.count(F.lit(1)).alias("attachment_count"))
    return tenders.select("post_id").join(lines, "post_id", "left").join(counts, "post_id", "left").select(
        "post_id", F.coalesce("item_count", F.lit(0)).alias("item_count"), "total_qty", F.coalesce("attachment_count", F.lit(0)).alias("attachment_count"),
    )


def modal_category(tenders: DataFrame, current: DataFrame) -> DataFrame:
    """(post_id, category_guess): the most frequent category of a tender's current lines without accessories, ties by name; else the stored one."""
    own = current.where(F.coalesce(F.col("is_accessory"), F.lit(0)) == 0).where(F.col("category_guess").isNotNull())
    counts = own.groupBy("post_id", "category_guess").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("post_id").agg(F.min_by("category_guess", F.struct(-F.col("n"), "category_guess")).alias("best"))
    return tenders.select("post_id", "category_guess").join(best, "post_id", "left").select("post_id", F.coalesce("best", "category_guess").alias("category_guess"))


def summary(tenders: DataFrame, items: DataFrame, attachments: DataFrame, history: DataFrame) -> DataFrame:
    """One row of totals. Items of retired files count as well. Each table gives its totals as (name, n) rows; these few rows become the columns of one."""
    codes = items.select(F.explode(F.array(F.struct(F.lit("m").alias("kind"), F.col("nupco_code").alias("code")), F.struct(F.lit("r").alias("kind"), F.col("rdl_code").alias("code")))).alias("c"))
    every = F.count(F.lit(1))
    parts = [
        (tenders, {"tenders": every, "listed": F.count_if(F.col("is_listed") == 1), "open_tenders": F.count_if(is_open())}), (items, {"items_all_versions": every}),
        (codes.select("c.*").where(F.col("code").isNotNull()).distinct(), {"codes": every}),
        (attachments, {"files": F.count_if(F.col("is_current") == 1), "parse_failed": F.count_if(F.col("parse_status") == "failed")}), (history, {"changes": every}),
    ]
    rows = [df.agg(F.array(*[F.struct(F.lit(name).alias("name"), n.alias("n")) for name, n in own.items()]).alias("a")).select(F.explode("a").alias("e")).select("e.*") for df, own in parts]
    names = [name for _, own in parts for name in own]
    return reduce(lambda x, y: x.unionByName(y), rows).agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])


def by_status(tenders: DataFrame) -> DataFrame:
    return tenders.groupBy(F.coalesce("status_label", F.lit("(none)")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def by_country(tenders: DataFrame) -> DataFrame:
    return tenders.groupBy(country_of().alias("country")).agg(F.count(F.lit(1)).alias("tenders"), F.count_if(is_open()).alias("open_tenders"))


def source_totals(tenders: DataFrame, items: DataFrame, attachments: DataFrame) -> DataFrame:
    """(source, tenders, items, files): totals per portal; each id counts once."""
    count = lambda df, name: df.select("id", "post_id").dropDuplicates(["id"]).groupBy("post_id").agg(F.count(F.lit(1)).alias(name))
    own = tenders.select("post_id", F.coalesce("source", F.lit("nupco")).alias("source"))
    joined = own.join(count(items, "i"), "post_id", "left").join(count(attachments, "f"), "post_id", "left")
    return joined.groupBy("source").agg(F.count(F.lit(1)).alias("tenders"), F.coalesce(F.sum("i"), F.lit(0)).alias("items"), F.coalesce(F.sum("f"), F.lit(0)).alias("files"))


def group_summary(rows: DataFrame, key: Column, value: Column, names: Column, amount: Column, flag: Column, at: Column, top: int | None = 100) -> DataFrame:
    """Per key: lines, smallest, exact median and largest value, the sorted distinct names, the sum of amounts, how many lines have the flag 1, 0 and none, and the latest date.

    Nulls of value, names and amount count for nothing. The report shows the `top` keys with the most lines, ties by key: these are
    found by a count first, so that medians and names are computed for them only.
    The median is exact: the mean of the middle two.
    """
    own = rows.select(key.alias("key"), value.alias("v"), names.alias("nm"), amount.alias("am"), flag.alias("fl"), at.alias("at")).where(F.col("key").isNotNull())
    if top is not None:
        largest = rows.select(key.alias("key")).where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key").limit(top)
        own = own.join(F.broadcast(largest.select("key")), "key", "left_semi")
    return own.groupBy("key").agg(
        F.count(F.lit(1)).alias("lines"), F.min("v").alias("min_value"), F.median("v").alias("median_value"), F.max("v").alias("max_value"),
        F.array_join(F.array_sort(F.collect_set("nm")), ",").alias("names"), F.sum(F.coalesce("am", F.lit(0.0))).alias("amount"),
        F.count_if(F.col("fl") == 1).alias("flagged"), F.count_if(F.col("fl") == 0).alias("unflagged"), F.count_if(F.col("fl").isNull()).alias("unknown"), F.max("at").alias("latest"),
    ).orderBy(F.desc("lines"), "key")


#: Sort orders by name: columns with their direction; nulls always go last and the key settles ties.
SORTS = {
    "deadline_asc": (("submission_ts", True),), "deadline_desc": (("submission_ts", False),), "opening_desc": (("opening_ts", False),), "opening_asc": (("opening_ts", True),),
    "qty_desc": (("qty", False),),
}
CATALOGUE_SORTS = {
    "deadline_asc": (("latest_deadline", True),), "deadline_desc": (("latest_deadline", False),), "opening_desc": (("latest_deadline", False),), "opening_asc": (("latest_deadline", True),),
    "qty_desc": (("total_qty", False),), "relevance": (("tender_count", False), ("total_qty", False)),
}
#: The orders of awarded lines.
AWARD_SORTS = {
    "date_desc": (("published_at", False),), "date_asc": (("published_at", True),), "cost_asc": (("unit_cost", True),), "cost_desc": (("unit_cost", False),), "value_desc": (("total_value", False),),
}


def page(rows: DataFrame, order: tuple[tuple[str, bool], ...], tie: str, limit: int, offset: int = 0, most: int = 500) -> DataFrame:
    """One page of a sorted result: nulls last, ties by key, limit held between 0 and `most`, offset not below 0."""
    by = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]
    return rows.orderBy(*by, tie).offset(max(0, offset)).limit(max(0, min(limit, most)))


def counted_page(rows: DataFrame, order: tuple[tuple[str, bool], ...], tie: str, limit: int, offset: int = 0, most: int = 500) -> DataFrame:
    """page, with the number of all rows as `total`, one scalar subquery. A page behind the last row is empty."""
    return page(rows.withColumn("total", rows.agg(F.count(F.lit(1)).alias("n")).scalar()), order, tie, limit, offset, most)


def search_page(rows: DataFrame, scores: DataFrame | None, key: str, sort: str = "relevance", limit: int = 50, offset: int = 0, then: tuple[tuple[str, bool], ...] = (), **filters) -> DataFrame:
    """One page of a search as users call it: words, filters, order and total together.

    scores: (key, score) of the rows that the words match, or None where none are given; then score is null. By relevance a search is ordered by score,
    then by `then`; without words or for an unknown order by the default.
    """
    found = filtered(rows, **filters)
    found = found.withColumn("score", F.lit(None).cast("double")) if scores is None else found.join(scores.select(key, F.round("score", 6).alias("score")), key)
    order = pick_sort(sort, SORTS, scores is not None)
    return counted_page(found, (("score", False), *then) if order is None else order, key, limit, offset)


def tender_page(tenders: DataFrame, attachments: DataFrame, items: DataFrame, history: DataFrame, awards: DataFrame, most_items: int = 1000, most_changes: int = 100) -> DataFrame:
    """(post_id, tender_id, title_en, files, item_total, items, changes, awards): a tender's page.

    Current files by role; the first `most_items` lines of current files by page and row, and the number of all; the `most_changes` latest changes; awarded lines by decision,
    item and beneficiary. Lists are cut while they are ranked, before anything of a tender is gathered; each id counts once.
    """
    files = attachments.where(F.col("is_current") == 1).dropDuplicates(["id"])
    own = items.join(files.select(F.col("id").alias("attachment_id")), "attachment_id", "left_semi").dropDuplicates(["id"])

    def listed(df: DataFrame, name: str, order: list[Column], most: int | None, *cols: str) -> DataFrame:
        if most is not None:
            df = df.withColumn("_rank", F.row_number().over(Window.partitionBy("post_id").orderBy(*order))).where(F.col("_rank") <= most)
            return df.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct("_rank", *cols))).alias("_l")).select("post_id", F.transform("_l", lambda r: F.struct(*[r[c].alias(c) for c in cols])).alias(name))
        return df.groupBy("post_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))

    parts = [
        listed(files, "files", [], None, "role", "id", "filename", "version"),
        own.groupBy("post_id").agg(F.count(F.lit(1)).alias("item_total")),
        listed(own, "items", [F.col("source_page").asc_nulls_first(), F.col("row_index").asc_nulls_first(), F.col("id")], most_items, "id", "description", "qty"),
        listed(history.dropDuplicates(["id"]).withColumn("_at", F.try_to_timestamp("changed_at")), "changes", [F.col("_at").desc_nulls_last(), F.col("id").desc()], most_changes, "id", "field", "old_value", "new_value"),
        listed(awards, "awards", [], None, "award_no", "item_no", "beneficiary", "unit_cost"),
    ]
    out = reduce(lambda a, b: a.join(b, "post_id", "left"), parts, tenders.select("post_id", "tender_id", "title_en"))
    lists = [F.coalesce(c, F.array()).alias(c) for c in ("items", "changes", "awards")]
    return out.select("post_id", "tender_id", "title_en", F.coalesce("files", F.array()).alias("files"), F.coalesce("item_total", F.lit(0)).alias("item_total"), *lists)


def pick_sort(requested: str, known: dict, matched: bool, default: str = "opening_desc") -> tuple[tuple[str, bool], ...] | None:
    """The columns of a requested order; None (by score) for relevance with a search; the default for all else."""
    if requested in known:
        return known[requested]
    return None if requested == "relevance" and matched else known.get(default)


def filtered(rows: DataFrame, category: str | None = None, status: str | None = None, open_only: bool = False, hide_accessories: bool = False, country: str | None = None) -> DataFrame:
    """Rows under the filters that are set; an unknown country is no filter."""
    if category:
        rows = rows.where(F.col("category_guess") == category)
    if status:
        rows = rows.where(F.col("status_label") == status)
    if open_only:
        rows = rows.where(is_open())
    if hide_accessories and "is_accessory" in rows.columns:
        rows = rows.where(F.col("is_accessory") == 0)
    if (country or "").upper() in COUNTRIES:
        rows = rows.where(country_of() == country.upper())
    return rows


def text_filter(columns: list[str], query: str, bare_columns: tuple[str, ...] = (), most: int = 8) -> Column:
    """Rows in which every one of the first eight tokens of query stands in one of the columns, letter case ignored; in bare columns without dashes and blanks.

    Characters with a meaning in patterns stand for themselves; tokens without any letter or digit are left out.
    """
    import re

    tokens = [t for t in re.findall(r"[\w.%+/-]+", query or "") if re.search(r"[^\W_]", t)][:most]
    held = lambda c, t: F.contains(F.lower(F.col(c)), F.lit(t.lower()))
    every = F.lit(True)
    for t in tokens:
        bare = re.sub(r"[-\s]", "", t)
        some = [F.coalesce(held(c, bare if c in bare_columns else t), F.lit(False)) for c in (*columns, *bare_columns)]
        every = every & reduce(lambda a, b: a | b, some)
    return every


def recent_changes(history: DataFrame, tenders: DataFrame, kind: str | None = None, limit: int = 100) -> DataFrame:
    """The latest changes, newest first, with their tender where it is known; each id once."""
    own = history.dropDuplicates(["id"])
    own = own.where(F.col("change_kind") == kind) if kind else own
    newest = own.orderBy(F.desc("id")).limit(max(0, min(limit, 1000)))
    heads = tenders.select("post_id", "title_en", F.col("status_label").alias("tender_status"), "url")
    return newest.join(heads, "post_id", "left").select("id", "changed_at", "change_kind", "tender_id", "post_id", "field", "old_value", "new_value", "title_en", "tender_status", "url")
