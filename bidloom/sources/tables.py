"""Reading stored tables: snapshots, databases, bound SQL; writing run events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bidloom.schemas import RUNS, TABLES, conform


def snapshot(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of a snapshot folder (<name>.parquet), by its stored schema: files of older shape get null or default columns."""
    return conform(spark.read.option("mergeSchema", "true").parquet(f"{path}/{name}.parquet"), name)


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest full state of a table that is kept as <path>/state=<number> folders."""
    states = spark.read.parquet(path)
    newest = states.agg(F.max("state")).first()[0]
    return states.where(F.col("state") == newest).drop("state")


def database_table(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 64, **options: str) -> DataFrame:
    """A table of a database that a JDBC driver on the class path reaches, read in `parts` ranges of a numeric key where its bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    df = reader.load()
    return conform(df, name) if name in TABLES else df


def run_sql(spark: SparkSession, text: str, **values: object) -> DataFrame:
    """SQL with named parameters (:name); values are bound, never pasted into the text."""
    return spark.sql(text, args=values)


def record_run(spark: SparkSession, path: str, **event: object) -> None:
    """Appends one event of a run; the latest event of a run_id is its state."""
    schema = StructType([*RUNS.fields, StructField("event_at", StringType())])
    spark.createDataFrame([tuple(event.get(f.name) for f in schema.fields)], schema).write.mode("append").parquet(path)


def without_paths(files: DataFrame) -> DataFrame:
    """Files whose scratch copies are gone: local paths blanked."""
    return files.withColumn("local_path", F.lit(None).cast("string"))


def document_lookup(attachments: DataFrame) -> DataFrame:
    """(id, action, target): where a document is served from: its stored copy, else a redirect to its address, else nowhere."""
    kept, away = F.nullif("local_path", F.lit("")), F.nullif("url", F.lit(""))
    action = F.when(kept.isNotNull(), "stored").when(away.isNotNull(), "redirect").otherwise("missing")
    return attachments.select("id", action.alias("action"), F.coalesce(kept, away).alias("target"))
