"""History of changing attributes, kept as insert-only satellites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.skew import with_slices

RECORD = "_record"


def attribute_value(text: Column) -> Column:
    """A value as it compares and appears: trimmed, null as '', whole decimals as integers."""
    plain = F.coalesce(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit(""))
    return F.regexp_replace(plain, r"^([+-]?[0-9]+)\.0*$", "$1")


def utc_text(micros: Column) -> Column:
    """Microseconds since 1970 as yyyy-MM-ddTHH:mm:ssZ, whatever the session's zone is."""
    seconds = F.floor(micros / F.lit(1_000_000)).cast("long")
    day, rest = F.floor(seconds / 86400).cast("int"), F.pmod(seconds, F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))
    return F.concat(F.date_from_unix_date(day).cast("string"), F.lit("T"), clock, F.lit("Z"))


def _deliveries(history: DataFrame) -> DataFrame:
    """All writes as delivered, with their instant in microseconds; rows without tender, field or readable instant are left out."""
    return history.select("id", "post_id", "field", "old_value", "new_value", F.unix_micros(F.try_to_timestamp("changed_at")).alias("at")).where(
        F.col("post_id").isNotNull() & F.col("field").isNotNull() & F.col("at").isNotNull(),
    )


def change_rates(history: DataFrame, fast: float = 1.5, slow: float = 0.6) -> DataFrame:
    """Writes per entity of each field and the satellite that holds it: fast, medium or slow. One row per field."""
    tenders = F.approx_count_distinct("post_id")
    rate = F.count(F.lit(1)) / F.greatest(tenders, F.lit(1))
    return (
        history.where((F.col("field") != RECORD) & F.col("post_id").isNotNull())
        .groupBy("field")
        .agg(rate.alias("rate"))
        .withColumn("satellite", F.when(F.col("rate") >= fast, "fast").when(F.col("rate") <= slow, "slow").otherwise("medium"))
    )


def satellite_rows(history: DataFrame, least: int = 10_000) -> DataFrame:
    """Insert-only satellite rows (satellite, post_id, field, slice_no, at, seq, val, hash_diff): one per version, none for a write that changes nothing.

    The first row of an attribute is its old value before the first write, valid from the tender's `_record` write (null where there is
    none); then one row for every write whose new value has another hash than the standing one. Writes apply in the order of their
    instants, then ids, null ids first. Redelivered rows count once. An attribute that holds a large share of all rows is cut into slices of
    time; each slice gets the last write before it as a carried row, so no window needs the whole attribute. Rows without tender, field or
    readable instant are left out; null values are ''; columns of other names change nothing; an empty table gives none.
    """
    key = ["post_id", "field"]
    delivered = _deliveries(history)
    raw = delivered.where(F.col("field") != RECORD)
    writes = raw.select("id", *key, attribute_value(F.col("old_value")).alias("old_val"), attribute_value(F.col("new_value")).alias("new_val"), "at").dropDuplicates()
    changes, sliced = with_slices(writes, key, "at", "id", raw, least=least)
    rows = changes.select(*key, "slice_no", "at", "id", "old_val", "new_val", F.lit(False).alias("carried"))
    if sliced:
        # The last value of every slice goes to its key's next slice, as a row that only lends its value.
        ends = changes.groupBy(*key, "slice_no").agg(F.max_by("new_val", F.struct("at", "id")).alias("new_val"))
        to = F.lead("slice_no").over(Window.partitionBy(*key).orderBy("slice_no"))
        rows = rows.unionByName(ends.withColumn("slice_no", to).where(F.col("slice_no").isNotNull()).withColumn("carried", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(*key, "slice_no").orderBy(F.col("carried").desc(), "at", "id")
    standing = F.lag("new_val").over(order)
    steps = rows.select(*key, "slice_no", "at", "id", "old_val", "new_val", "carried", standing.alias("prev"), F.row_number().over(order).alias("n"))
    first = (F.col("n") == 1) & ~F.col("carried")
    before = F.coalesce(F.col("prev"), F.when(first, F.col("old_val")))
    steps = steps.withColumn("hash_diff", F.xxhash64("new_val")).withColumn("stand_hash", F.xxhash64(before))
    new = ~F.col("carried") & ((F.col("hash_diff") != F.col("stand_hash")) | (F.col("new_val") != before))
    start = F.struct(F.lit(None).cast("long").alias("at"), F.lit(-1).cast("long").alias("seq"), F.col("old_val").alias("val"))
    step = F.struct(F.col("at").alias("at"), F.coalesce("id", F.lit(-2)).alias("seq"), F.col("new_val").alias("val"))
    versions = F.filter(F.array(F.when(first, start), F.when(new, step)), lambda v: v.isNotNull())
    inserted = steps.select(*key, "slice_no", F.explode(versions).alias("v")).select(*key, "slice_no", "v.at", "v.seq", "v.val")
    # An attribute's start is the `_record` write of its tender; only starting rows need it.
    sighted = delivered.where(F.col("field") == RECORD).groupBy("post_id").agg(F.min("at").alias("record_at"))
    starts = inserted.where(F.col("seq") == -1).join(sighted, "post_id", "left").select(*key, "slice_no", F.col("record_at").alias("at"), "seq", "val")
    every = inserted.where(F.col("seq") != -1).unionByName(starts)
    rates = change_rates(history).select("field", "satellite")
    return every.join(F.broadcast(rates), "field").withColumn("hash_diff", F.xxhash64("val"))


def append_satellites(rows: DataFrame, path: str) -> None:
    """Append versions to the satellites under path, one folder per change rate."""
    rows.write.mode("append").partitionBy("satellite").parquet(path)


def validity_view(satellites: DataFrame) -> DataFrame:
    """Rows (post_id, field, valid_from, valid_to, val): ends come from the next version's start, computed on reading.

    valid_to is '' for the version in force, valid_from '' where the tender's first sighting is unknown. In a sliced
    attribute the end of a slice's last version is the first start of the slices after it.
    """
    key = ["post_id", "field"]
    order = Window.partitionBy(*key, "slice_no").orderBy(F.col("seq") != -1, "at", "seq")
    # Only sliced attributes have numbers above 0; the head of each such slice ends the slice before it.
    heads = satellites.where(F.col("slice_no") > 0).groupBy(*key, "slice_no").agg(F.min(F.struct(F.col("seq") != -1, "at", "seq")).alias("head"))
    before = F.coalesce(F.lag("slice_no").over(Window.partitionBy(*key).orderBy("slice_no")), F.lit(0))
    following = heads.select(*key, before.alias("slice_no"), F.col("head.at").alias("slice_end"))
    ended = satellites.select(*key, "slice_no", "at", "val", F.lead("at").over(order).alias("next_at"), F.lead(F.lit(1)).over(order).alias("has_next"))
    closed = ended.join(following, [*key, "slice_no"], "left")
    end = F.when(F.col("has_next").isNotNull(), F.col("next_at")).otherwise(F.col("slice_end"))
    return closed.select(
        *key, F.coalesce(utc_text(F.col("at")), F.lit("")).alias("valid_from"), F.coalesce(utc_text(end), F.lit("")).alias("valid_to"), "val",
    )
