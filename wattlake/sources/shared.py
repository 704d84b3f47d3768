"""Names in a folder that all machines share, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, hidden names aside; nothing if there is no such folder."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    found = [status.getPath().getName() for status in system.listStatus(place)]
    return [name for name in found if not name.startswith(("_", "."))]


def touch(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)
