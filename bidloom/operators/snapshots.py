"""What changed between full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_key(hash_text: Column) -> Column:
    """A content hash without letter case and outer blanks; null stays a value of its own."""
    return F.lower(F.regexp_replace(hash_text, r"(?U)^\s+|\s+$", ""))


def standing_rows(snapshots: DataFrame, key: str = "post_id", number: str = "snapshot_no", seen: str = "last_seen_at", states: tuple[str, ...] = ("content_hash", "is_listed")) -> DataFrame:
    """One row per key and snapshot: the one with the latest `seen` (as an instant; unreadable or null comes first).

    Ties are settled by the state columns, so the choice doesn't depend on row order. Rows without key or number are left out.
    Copies of a hot key collapse on the map side before anything is shuffled.
    """
    order = F.struct(F.coalesce(F.unix_micros(F.try_to_timestamp(F.col(seen).cast("string"))), F.lit(-(2**62))).alias("at"), *[F.col(s).alias(s) for s in states])
    return (
        snapshots.where(F.col(key).isNotNull() & F.col(number).isNotNull())
        .select(key, number, order.alias("best"))
        .groupBy(key, number)
        .agg(F.max("best").alias("best"))
        .select(key, number, *[F.col(f"best.{s}").alias(s) for s in states])
    )


def snapshot_changes(snapshots: DataFrame, key: str = "post_id", number: str = "snapshot_no", seen: str = "last_seen_at") -> DataFrame:
    """Rows (snapshot_no, post_id, change_kind): keys added, removed or changed from each snapshot to the next.

    Each key's rows are ordered by the index of their snapshot in the list of snapshots that exist: lag shows a changed hash or listing
    flag, a gap of the index a removal after its start and an addition at its end. The first snapshot yields nothing. A key has at most
    one row per snapshot by then, so no window holds more rows than there are snapshots. Repeated rows and columns of other names change
    nothing; an empty table gives an empty result.
    """
    rows = standing_rows(snapshots.select(key, number, seen, "content_hash", "is_listed"), key, number, seen).withColumn("hash", hash_key("content_hash"))
    # The list has one row per snapshot; its order is found in one small task.
    listed = snapshots.where(F.col(number).isNotNull()).select(number).distinct()
    index = listed.select(
        number, F.row_number().over(Window.orderBy(number)).alias("at"), F.lead(number).over(Window.orderBy(number)).alias("next_no"),
    )
    own = Window.partitionBy(key).orderBy("at")
    seen_rows = rows.join(index, number).select(
        key, number, "at", "next_no", "hash", "is_listed",
        F.lag("at").over(own).alias("prev_at"), F.lag("hash").over(own).alias("prev_hash"), F.lag("is_listed").over(own).alias("prev_listed"),
        F.lead("at").over(own).alias("next_at"),
    )
    together = F.col("prev_at") == F.col("at") - 1
    same = F.col("hash").eqNullSafe(F.col("prev_hash")) & F.col("is_listed").eqNullSafe(F.col("prev_listed"))
    here = F.when((F.col("at") > 1) & ~F.coalesce(together, F.lit(False)), F.lit("added")).when(together & ~same, F.lit("changed"))
    gone = F.when(F.col("next_no").isNotNull() & ~F.coalesce(F.col("next_at") == F.col("at") + 1, F.lit(False)), F.lit("removed"))
    events = F.filter(
        F.array(F.struct(F.col(number).alias("no"), here.alias("kind")), F.struct(F.col("next_no").alias("no"), gone.alias("kind"))),
        lambda e: e["kind"].isNotNull(),
    )
    return seen_rows.select(key, F.explode(events).alias("e")).select(F.col("e.no").alias(number), key, F.col("e.kind").alias("change_kind"))
