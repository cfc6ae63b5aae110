"""Keeping a table current from incoming records: insert, update, field-level log, soft delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.functions.scalars import compare_key

# The tender fields whose changes are logged.
TRACKED = (
    "tender_id", "title_en", "title_ar", "status_label", "status_slugs", "opening_date", "submission_deadline", "bid_opening", "booklet_price_sar", "buy_url", "url",
    "item_count", "category_guess", "subcategory", "buyer", "method",
)

#: Columns that the upsert itself writes.
STAMPS = ("first_seen_at", "last_seen_at", "last_changed_at")


def _present(incoming: DataFrame, column: str) -> Column:
    """Whether a record has a field at all: named in its `present` array where there is one, else every column counts."""
    if column not in incoming.columns:
        return F.lit(False)
    return F.array_contains(F.col("new.present"), column) if "present" in incoming.columns else F.lit(True)


def upsert(stored: DataFrame, incoming: DataFrame, at: str, run_id: int, key: str = "post_id", tracked: tuple[str, ...] = TRACKED) -> DataFrame:
    """The full outer join of stored and incoming rows by key, one row per key: (key, state, row, changes).

    state is new, changed, same, or kept (not delivered). row is the new state of the stored columns: a field that the record lacks
    keeps its value, a present null overwrites; last_seen_at becomes `at` for delivered rows, last_changed_at for new and
    changed ones, first_seen_at for new ones. changes is an array of (field, old_value, new_value, change_kind): `_record` for a new row, one
    entry per tracked field whose values compare unequal, and delist or relist when is_listed turns. Rows with a null key are left out;
    of several rows of one key the greatest stands, so that repeated deliveries change nothing.
    """
    fields = [c for c in stored.columns if c != key]
    old = _one_each(stored, key)
    new = _one_each(incoming, key)
    joined = old.select(key, F.struct(*fields).alias("old")).join(new.select(key, F.struct(*[c for c in new.columns if c != key]).alias("new")), key, "full_outer")
    fresh, gone = F.col("old").isNull(), F.col("new").isNull()
    differs = {c: _present(incoming, c) & (compare_key(F.col(f"old.{c}")) != compare_key(F.col(f"new.{c}"))) for c in tracked if c in incoming.columns and c in fields}
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")

    def change(when: Column, field: str, a: Column, b: Column, kind: Column) -> Column:
        return F.when(when, F.struct(F.lit(field).alias("field"), a.alias("old_value"), b.alias("new_value"), kind.alias("change_kind")))

    both = ~fresh & ~gone
    null = F.lit(None).cast("string")
    name = text("new", "tender_id") if "tender_id" in incoming.columns else null
    log = [change(fresh, "_record", null, name, F.lit("new"))] + [change(both & d, c, text("old", c), text("new", c), F.lit("update")) for c, d in differs.items()]
    if "is_listed" in incoming.columns and "is_listed" in fields:
        turned = both & _present(incoming, "is_listed") & ~F.col("old.is_listed").eqNullSafe(F.col("new.is_listed"))
        log.append(change(turned, "is_listed", text("old", "is_listed"), text("new", "is_listed"), F.when(F.coalesce(F.col("new.is_listed"), F.lit(0)) != 0, "relist").otherwise("delist")))
    logged = joined.withColumn("changes", F.filter(F.array(*log), lambda c: c.isNotNull()))
    state = F.when(fresh, "new").when(gone, "kept").when(F.size("changes") > 0, "changed").otherwise("same")

    def value(c: str) -> Column:
        was = F.col(f"old.{c}")
        if c == "first_seen_at":
            return F.when(fresh, at).otherwise(was)
        if c == "last_seen_at":
            return F.when(gone, was).otherwise(at)
        if c == "last_changed_at":
            return F.when(F.col("state").isin("new", "changed"), at).otherwise(was)
        if c not in incoming.columns:
            return was
        return F.when(gone | ~_present(incoming, c), was).otherwise(F.col(f"new.{c}"))

    staged = logged.withColumn("state", state)
    return staged.select(key, "state", F.struct(*[value(c).cast(stored.schema[c].dataType).alias(c) for c in fields]).alias("row"), "changes", F.lit(at).alias("changed_at"), F.lit(run_id).alias("run_id"))


def _one_each(rows: DataFrame, key: str) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*others)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def new_state(result: DataFrame, key: str = "post_id") -> DataFrame:
    """The stored table after an upsert."""
    return result.select(key, "row.*")


def history_rows(result: DataFrame, key: str = "post_id") -> DataFrame:
    """The log of an upsert: one row per change."""
    return result.select(key, F.col("row.tender_id").alias("tender_id"), F.explode("changes").alias("c"), "changed_at", "run_id").select(key, "tender_id", "c.*", "changed_at", "run_id")


def delist_unseen(stored: DataFrame, seen: DataFrame, source: str, at: str, run_id: int, complete: bool, key: str = "post_id") -> tuple[DataFrame, DataFrame]:
    """(table, log): listed rows of one source that a complete crawl didn't see are unlisted, never deleted; other sources stay.

    A null source counts as the first portal. An incomplete crawl changes nothing.
    """
    log_columns = f"{key} bigint, tender_id string, field string, old_value string, new_value string, change_kind string, changed_at string, run_id int"
    if not complete:
        return stored, stored.sparkSession.createDataFrame([], log_columns)
    known = seen.select(key).where(F.col(key).isNotNull()).distinct().withColumn("was_seen", F.lit(True))
    own = (F.coalesce(F.col("source"), F.lit("nupco")) == source) & (F.col("is_listed") == 1)
    marked = stored.join(known, key, "left").withColumn("gone", F.coalesce(own, F.lit(False)) & F.col("was_seen").isNull())
    table = marked.withColumns(
        {"is_listed": F.when(F.col("gone"), 0).otherwise(F.col("is_listed")), "last_changed_at": F.when(F.col("gone"), at).otherwise(F.col("last_changed_at"))},
    ).select(*stored.columns)
    log = marked.where("gone").select(
        key, "tender_id", F.lit("is_listed").alias("field"), F.lit("1").alias("old_value"), F.lit("0").alias("new_value"), F.lit("delist").alias("change_kind"), F.lit(at).alias("changed_at"), F.lit(run_id).alias("run_id"),
    )
    return table, log
