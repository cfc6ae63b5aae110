"""Helpers that keep one hot key from becoming one hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of all rows from which a key counts as hot: at most PARTS keys can reach a share of 1 / PARTS, so the list of hot keys is small by proof.
PARTS = 1000


def hot_keys(rows: DataFrame, keys: list[str], *more: Column, parts: int = PARTS, least: int = 10_000) -> DataFrame:
    """Keys that hold more than max(least, 1/parts) of the rows, with key_rows and the aggregates in more.

    At most `parts` rows come out, whatever the input is (every one of them holds over 1/parts of all rows), so the result may be
    broadcast. Rows with a null in any key are not counted.
    """
    some = rows
    for k in keys:
        some = some.where(F.col(k).isNotNull())
    total = rows.count()
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"), *more).where(F.col("key_rows") > max(least, total // parts))


def with_slices(rows: DataFrame, keys: list[str], order: str, tie: str, raw: DataFrame | None = None, slices: int = 256, least: int = 10_000) -> tuple[DataFrame, bool]:
    """(rows with slice_no, whether any key is sliced): 0 for ordinary keys; for hot keys a number that grows with (order, tie) so that a key's rows spread over
    `slices` groups.

    order and tie are numeric columns. Slices end at quantiles of the key's rows, so an outlier moves none of them; where one `order` fills several
    slices, its rows are dealt to these by the quantiles of `tie`, null ties to the first. Hot keys are looked for in raw, which has the same columns and
    may hold rows more than once, so that finding them repeats no work that rows cost; without any, rows just get the number 0.
    """
    raw = rows if raw is None else raw
    hot = hot_keys(raw, keys, least=least).select(*keys)
    if hot.isEmpty():
        return rows.withColumn("slice_no", F.lit(0)), False
    cuts = F.array(*[F.lit(k / slices) for k in range(1, slices)])
    own = raw.join(F.broadcast(hot), keys)
    bounds = own.groupBy(*keys).agg(F.percentile_approx(order, cuts).alias("order_cuts"), F.percentile_approx(tie, cuts).alias("tie_cuts"))
    joined = rows.join(F.broadcast(bounds), keys, "left")
    below = lambda name, x: F.size(F.filter(name, lambda b: b < x))
    same = F.size(F.filter("order_cuts", lambda b: b == F.col(order)))
    part = F.when(same > 0, F.floor(F.coalesce(below("tie_cuts", F.col(tie)), F.lit(0)) * same / slices)).otherwise(0)
    number = F.when(F.col("order_cuts").isNull(), 0).otherwise(below("order_cuts", F.col(order)) + part)
    return joined.withColumn("slice_no", F.coalesce(number, F.lit(0)).cast("int")).drop("order_cuts", "tie_cuts"), True


def skew_safe_lookup(rows: DataFrame, found: DataFrame, keys: list[str], spread: str, size: str, rows_per_part: int = 100_000) -> DataFrame:
    """Inner join of rows with found (one row per key), where a key may hold any share of rows.

    found has a column `size`, the number of rows of its key. Keys above max(rows_per_part, 1/PARTS of all) get several copies
    in `found` and as many salts, dealt by the hash of `spread`; the list of those keys is bounded by proof and broadcast.
    """
    total = rows.count()
    limit = max(rows_per_part, total // PARTS)
    salts = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(limit)).cast("int"))
    hot = found.where(F.col(size) > limit).select(*keys, salts.alias("salts"))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.col("salts"))).cast("int"),
    ).drop("salts")
    copies = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(F.col(size) > limit, salts - 1).otherwise(F.lit(0)))))
    return salted.join(copies, [*keys, "salt"]).drop("salt")
