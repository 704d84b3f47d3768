"""Readings, metrics and envelopes in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.strict_json import with_body
from wattlake.operators.envelopes import malformed, map_envelopes, with_decoded_map
from wattlake.operators.stored import upsert_latest
from wattlake.schemas import FLAT_METRIC, KAFKA_ROW, READING, READING_JSON, RUN
from wattlake.session import written
from wattlake.sources import shared

# Stored readings keep the order in which they came in, for `stored.upsert_latest`.
_STORED = (
    T.StructType(READING.fields)
    .add("ingest_order", T.LongType())
    .add("ingest_position", T.LongType())
    .add("date", T.DateType())
)


def _decoded(lines: DataFrame) -> DataFrame:
    """The readings among JSON lines.

    Lines are decoded by a function rather than by the reader: the reader decodes the columns
    a query asks for, and a defect elsewhere in the line would go unnoticed.
    """
    rows = with_body(lines, F.col("value"), READING_JSON, "r")
    return rows.filter("r is not null").select(
        "r.meter_id", F.col("r.timestamp").alias("ts"), "r.kwh", "r.voltage", "r.current"
    )


def read_readings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Readings with a fixed schema; JSON lines that cannot be decoded are left out."""
    if fmt == "json":
        return _decoded(spark.read.text(path))
    return spark.read.schema(_STORED).parquet(path)


def stream_readings(
    spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int = 1000
) -> DataFrame:
    """New files of readings as a stream; each trigger takes a bounded number of files."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "json":
        return _decoded(reader.text(path))
    return reader.schema(_STORED).parquet(path)


def write_readings(
    readings: DataFrame, path: str, order: Column | None = None, mode: str = "append"
) -> None:
    """Parquet by date, ordered by meter within files.

    Rebalancing joins small partitions and splits a date that has most of the rows; the
    order gives row groups narrow ranges of meters, which the read of one meter skips by.
    A later reading of the same meter and second is appended like any other, with its place in
    the order of writing: `order`, by default the time, and the position in what is written.
    `stored.upsert_latest` keeps the last when reading.
    """
    _by_date(_ordered(readings, order)).write.mode(mode).partitionBy("date").parquet(path)


def _ordered(readings: DataFrame, order: Column | None) -> DataFrame:
    """Readings as they are stored, with their place in the order of writing."""
    now = F.unix_micros(F.current_timestamp())
    ingest = (now if order is None else order).cast("bigint").alias("ingest_order")
    position = F.monotonically_increasing_id().alias("ingest_position")
    return readings.select(*READING.fieldNames(), ingest, position, F.to_date("ts").alias("date"))


def _by_date(stored: DataFrame) -> DataFrame:
    return stored.hint("rebalance", "date").sortWithinPartitions("date", "meter_id", "ts")


def merge_readings(
    readings: DataFrame, path: str, order: Column | None = None, grain: str = "second"
) -> None:
    """Write readings into a store that holds one for each meter and second: the last written.

    Only the dates that the readings touch are read and replaced, each as a whole. What replaces
    them is written down first, so a merge that fails midway can be repeated with the same `order`.
    Reads of the store then need no `stored.upsert_latest`, and overwritten readings take no room.
    One merge at a time: two at once could replace the same date.
    """
    spark = readings.sparkSession
    fresh = written(_ordered(readings, order), "merge")
    days = [row["date"] for row in fresh.select("date").distinct().collect()]  # a row for each date
    both = fresh
    if shared.names(spark, path):
        touched = F.col("date").isin([day for day in days if day is not None])
        if None in days:
            touched = touched | F.col("date").isNull()
        both = read_readings(spark, path).filter(touched).unionByName(fresh)
    kept = written(upsert_latest(both, grain, ["ingest_order", "ingest_position"]), "merged")
    writer = _by_date(kept).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """The 12-column flat table."""
    metrics.select(FLAT_METRIC.fieldNames()).write.mode(mode).parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FLAT_METRIC).parquet(path)


def append_envelopes(envelopes: DataFrame, path: str) -> None:
    """Add envelopes to a dataset; `rollups.dataset_info` counts them."""
    envelopes.write.mode("append").parquet(path)


def _landed(lines: DataFrame) -> DataFrame:
    arrived = F.col("_metadata.file_modification_time").alias("received_at")
    return with_decoded_map(lines.select("value", arrived))


def read_map_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes posted to a landing folder, one JSON object per line.

    They are stamped with the time their file arrived.
    """
    return map_envelopes(_landed(spark.read.text(path)))


def rejected_map_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a landing folder that are no envelopes, with the time their file arrived."""
    return malformed(_landed(spark.read.text(path)))


def stream_map_envelopes(
    spark: SparkSession, path: str, files_per_trigger: int = 1000
) -> DataFrame:
    """The same, as a stream of new files."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    return map_envelopes(_landed(reader.text(path)))


def stream_kafka_files(
    spark: SparkSession, path: str, files_per_trigger: int = 1000
) -> DataFrame:
    """Kafka-shaped rows from files, for archives of a topic and for tests."""
    reader = spark.readStream.schema(KAFKA_ROW).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Results of benchmark runs, one JSON object per line, for `profile.compare_runs`."""
    return spark.read.schema(RUN).json(path)
