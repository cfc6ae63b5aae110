"""Runs: book-keeping, digest, quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.functions.scalars import progress, table_cell


def run_states(events: DataFrame, now: str, hours: int = 6) -> DataFrame:
    """The latest event of every run; runs that have been running for more than six hours count as abandoned.

    events are appended: (run_id, mode, started_at, finished_at, status, event_at, notes). Times are ISO texts.
    """
    others = [c for c in events.columns if c != "run_id"]
    last = events.groupBy("run_id").agg(F.max_by(F.struct(*others), F.struct("event_at", F.coalesce("finished_at", F.lit("")))).alias("r")).select("run_id", "r.*")
    stale = (F.col("status") == "running") & (F.try_to_timestamp("started_at") < F.try_to_timestamp(F.lit(now)) - F.make_interval(hours=F.lit(hours)))
    return last.withColumns({"status": F.when(stale, "abandoned").otherwise(F.col("status")), "progress": progress(F.col("notes"))})


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(1)


def runs_of_history(history: DataFrame) -> DataFrame:
    """One row per run of the change log: (run_id, first_change, last_change, changes, new, updated, delisted, relisted)."""
    n = lambda k: F.count_if(F.col("change_kind") == k)
    own = history.select("id", "run_id", "changed_at", "change_kind").dropDuplicates(["id"])
    return own.groupBy("run_id").agg(
        F.min(F.unix_seconds(F.try_to_timestamp("changed_at"))).alias("first_change"), F.max(F.unix_seconds(F.try_to_timestamp("changed_at"))).alias("last_change"),
        F.count(F.lit(1)).alias("changes"), n("new").alias("new"), n("update").alias("updated"), n("delist").alias("delisted"), n("relist").alias("relisted"),
    )


def digest(tenders: DataFrame, history: DataFrame, run_id: int, as_of_days: tuple[int, int] = (0, 14), new: int = 60, changes: int = 40, closing: int = 60) -> DataFrame:
    """(section, position, text): the report of a run: totals per source, its new tenders, its latest changes, and pharma tenders that close within 14 days.

    Each section but the totals is a top list; texts are cells of a markdown table.
    """
    from pyspark.sql import Window

    own = history.where((F.col("run_id") == run_id) & (F.col("field") != "_record")).dropDuplicates(["id"])
    born = history.where((F.col("run_id") == run_id) & (F.col("field") == "_record")).select("post_id").distinct().join(tenders, "post_id")
    row = lambda *cols: F.concat_ws(" | ", *[table_cell(c) for c in cols])

    def section(name: str, df: DataFrame, order: list[Column], limit: int, *cols: Column) -> DataFrame:
        top = df.orderBy(*order).limit(limit)
        return top.select(F.lit(name).alias("section"), F.row_number().over(Window.orderBy(*order)).alias("position"), row(*cols).alias("text"))

    c = F.col
    soon = tenders.where((c("category_guess") == "pharma") & c("days_to_deadline").between(*as_of_days))
    totals = tenders.groupBy(F.coalesce("source", F.lit("nupco")).alias("source")).agg(
        F.count(F.lit(1)).alias("tenders"), F.count_if(F.col("is_listed") == 1).alias("listed"), F.max("last_changed_at").alias("latest"),
    )
    parts = [
        section("totals", totals, [c("source")], 1000, c("source"), c("tenders"), c("listed"), c("latest")),
        section("new", born, [c("post_id")], new, c("tender_id"), c("title_en"), c("status_label"), c("submission_ts")),
        section("changes", own, [c("id").desc()], changes, c("tender_id"), c("field"), c("old_value"), c("new_value")),
        section("closing", soon, [c("days_to_deadline"), c("post_id")], closing, c("tender_id"), c("title_en"), c("days_to_deadline")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def quality_checks(tenders: DataFrame, items: DataFrame, attachments: DataFrame) -> DataFrame:
    """(check_name, failures): rows that break each rule; coded_per_mille is the share of items with any code, in thousandths."""
    n = lambda name, df: df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
    files = attachments.dropDuplicates(["id"])
    lines = items.dropDuplicates(["id"])
    doubled = files.where(F.col("is_current") == 1).groupBy("post_id", "role").count().where(F.col("count") > 1)
    iso = r"^\d{4}-\d{2}-\d{2}$"
    bad_dates = tenders.where(reduce(lambda a, b: a | b, [F.coalesce(~F.col(c).rlike(iso), F.lit(False)) for c in ("opening_ts", "submission_ts", "bid_opening_ts")]))
    parts = [
        n("two_current_versions", doubled),
        n("items_without_file", lines.join(files.select(F.col("id").alias("attachment_id")), "attachment_id", "left_anti")),
        n("items_without_tender", lines.join(tenders.select("post_id"), "post_id", "left_anti")),
        n("negative_qty", lines.where(F.col("qty") < 0)),
        n("dates_not_iso", bad_dates),
        n("tenders_without_id", tenders.where(F.col("tender_id").isNull())),
        lines.agg(F.floor(F.count_if(F.col("nupco_code").isNotNull() | F.col("rdl_code").isNotNull()) * 1000 / F.greatest(F.count(F.lit(1)), F.lit(1))).cast("long").alias("failures")).select(F.lit("coded_per_mille").alias("check_name"), "failures"),
        n("items_without_code", lines.where(F.col("nupco_code").isNull() & F.col("rdl_code").isNull())),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
