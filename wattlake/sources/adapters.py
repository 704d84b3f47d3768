"""The driver's `events` table as meter readings and as benchmark runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import columns as C
from wattlake.schemas import EVENTS

SHARDS = 4

# The meter counts of the benchmark runs.
RUN_METERS = [10, 50, 100, 250, 500, 1000]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def total_meters(table: DataFrame):
    """The number of meters as a scalar subquery; it reads one column."""
    return table.agg(F.max("user_id") + 1).scalar()


def as_readings(table: DataFrame, total, shards: int = SHARDS) -> DataFrame:
    """Readings of an events table, batch or stream. `total` is the number of meters."""
    voltage = "(event_id % 450 + 1980) / 10.0D"
    amps = f"value * 1000.0D / ({voltage}) * ((event_id % 3 + 10) / 10.0D) * 100.0D"
    with_current = table.select(
        "event_id",
        F.col("user_id").alias("meter_index"),
        C.meter_id(F.col("user_id")).alias("meter_id"),
        "ts",
        F.col("value").alias("kwh"),
        F.expr(voltage).alias("voltage"),
        F.expr(f"floor({amps}) / 100.0D").alias("current"),
    )
    sharded = C.with_shard(with_current, total, shards)
    return sharded.withColumn("collector_id", C.collector_id(F.col("shard_id")))


def readings(spark: SparkSession, sf_dir: str, shards: int = SHARDS) -> DataFrame:
    table = events(spark, sf_dir)
    return as_readings(table, total_meters(table), shards)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one trial: its type is the language, its value the throughput.

    Microseconds per reading are cut to hundredths and null for no throughput; the memory is made
    from the number of the event, in quarters of a megabyte.
    """
    sizes = F.array(*[F.lit(m) for m in RUN_METERS])
    return events(spark, sf_dir).select(
        F.col("event_type").alias("language"),
        F.element_at(sizes, (F.col("user_id") % len(RUN_METERS) + 1).cast("int"))
        .cast("bigint")
        .alias("meters"),
        F.col("value").alias("readings_per_sec"),
        (F.floor(F.try_divide(F.lit(1e8), F.col("value"))) / F.lit(100.0)).alias("avg_us_per_read"),
        F.expr("(event_id % 4096) / 4.0D").alias("peak_mem_mb"),
    )
