"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "wattlake") -> SparkSession:
    """A session for one machine. On a cluster, use the session the cluster provides."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: `spark.checkpoint.dir`, or the context's own setting.

    Only a local session may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wattlake-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return os.path.join(shared_folder(spark), f"wattlake-{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of `df` with a table in the shared folder.

    Values that depend on the physical layout stay fixed afterwards, whatever
    tasks are run again, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
