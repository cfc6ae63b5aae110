"""Session defaults and table access."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "tenders", "tender_items", "tender_history", "attachments", "item_files", "tender_snapshots", "product_list",
    "eval_items", "mix_targets",
)


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bidloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register tables as temp views for SQL queries."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; only a local session without one gets its own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="bidloom-checkpoint-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
