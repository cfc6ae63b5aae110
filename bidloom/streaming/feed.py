"""Keeping tables current from a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bidloom.operators.upsert import history_rows, new_state, upsert
from bidloom.sources.sinks import swap_state


def record_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """Landed record files (JSON lines) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def keep_current(records: DataFrame, table: str, history: str, checkpoint: str, schema: StructType, key: str = "post_id") -> StreamingQuery:
    """Upserts every batch of records into <table>/state=n and writes its changes to <history>/batch=n; ends when all landed files are read.

    A batch reads state n, writes state n + 1 and its own folder of the log; both are overwritten if the batch runs again, so a
    restart after a loss applies each batch once.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.schema(schema).parquet(f"{table}/state={number}") if number else spark.createDataFrame([], schema)
        at = f"batch {number}"
        result = upsert(stored, batch, at, number, key).persist()
        swap_state(new_state(result, key), table, number + 1)
        history_rows(result, key).write.mode("overwrite").parquet(f"{history}/batch={number}")
        result.unpersist()

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """(start, end, kind, n, total) per window of time and kind; rows later than the watermark are dropped once their window is closed."""
    counted = events.withWatermark(at, late).groupBy(F.window(at, size), kind).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), kind, "n", "total")
