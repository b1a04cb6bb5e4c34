"""Session defaults and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests, benches and scripts; a cluster passes its own."""
    builder = (
        SparkSession.builder.appName("shelfrank")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where unset, a fresh one, in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfrank-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back with an empty lineage.

    A lost executor then re-reads files; it never re-runs the stages before the write. A given
    ``path`` is overwritten, for loops that keep only their last states.
    """
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
