"""Writing tables: snapshots, replaced parts, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.schemas import TABLES, conform

#: Folders among which a table's rows are dealt by key, so that replacing some keys rewrites few files.
BUCKETS = 64


def row_id(*keys: str):
    """A stable id of a row: the hash of its logical key."""
    return F.xxhash64(*keys)


def replace_parts(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Replaces all rows of the keys that occur in `rows`; rows of other keys stay.

    The table lies in `buckets` folders by the hash of the key; only folders of delivered keys are read and written again (dynamic
    partition overwrite). The untouched rows of those folders are staged beside the table before they are overwritten.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    if not _exists(spark, path):
        placed.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return
    touched = [r[0] for r in placed.select("bucket").distinct().collect()]  # at most `buckets` numbers
    stored = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    kept = stored.join(placed.select(key).distinct(), key, "left_anti")
    staged = f"{path.rstrip('/')}__staged"
    kept.unionByName(placed, allowMissingColumns=True).write.mode("overwrite").partitionBy("bucket").parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def swap_state(rows: DataFrame, path: str, number: int) -> str:
    """Writes a new full state of a table beside the old ones, as <path>/state=<number>; readers take the highest number."""
    out = f"{path.rstrip('/')}/state={number}"
    rows.write.mode("overwrite").parquet(out)
    return out


def seed(spark: SparkSession, snapshot: str, target: str, tables: tuple[str, ...] = tuple(TABLES)) -> dict[str, str]:
    """Loads a snapshot folder (<table>.parquet each): columns by name, local paths blanked; tables that the snapshot lacks come out empty."""
    out = {}
    for name in tables:
        source = f"{snapshot}/{name}.parquet"
        df = conform(spark.read.parquet(source), name) if _exists(spark, source) else spark.createDataFrame([], TABLES[name])
        if "local_path" in df.columns:
            df = df.withColumn("local_path", F.lit(None).cast("string"))
        df.write.mode("overwrite").parquet(out.setdefault(name, f"{target}/{name}.parquet"))
    return out


def dead_letters(rows: DataFrame, at: str, run_id: int) -> tuple[DataFrame, DataFrame]:
    """(good rows, failures) of rows with an error column: failures are (file_id, reason, occurred_at, run_id), reasons of at most 500 characters."""
    failures = rows.where(F.col("error").isNotNull()).select("file_id", F.substring("error", 1, 500).alias("reason"), F.lit(at).alias("occurred_at"), F.lit(run_id).alias("run_id"))
    return rows.where(F.col("error").isNull()).drop("error"), failures


def parse_status(files: DataFrame, items: DataFrame, failures: DataFrame) -> DataFrame:
    """(file_id, parse_status, parse_rows): failed where a failure was written, parsed with its number of items else; files without either are pending."""
    counts = items.groupBy("file_id").agg(F.count(F.lit(1)).alias("parse_rows"))
    bad = failures.select("file_id").distinct().withColumn("failed", F.lit(True))
    status = F.when(F.col("failed"), "failed").when(F.col("parse_rows") > 0, "parsed").otherwise("pending")
    return files.select("file_id").distinct().join(counts, "file_id", "left").join(bad, "file_id", "left").select("file_id", status.alias("parse_status"), F.coalesce("parse_rows", F.lit(0)).alias("parse_rows"))


def pending(attachments: DataFrame, stored_only: bool = False) -> DataFrame:
    """Files that still have to be read: never, or in vain; with stored_only only those with a local copy."""
    rows = attachments.where(F.col("parse_status").isNull() | F.col("parse_status").isin("pending", "failed"))
    return rows.where(F.col("local_path").isNotNull()) if stored_only else rows
