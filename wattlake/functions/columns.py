"""Identifiers, shards, load bands and time conversions as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The identifier format and the hour bands with their load factors.
METER_PREFIX = "METER-"
METER_DIGITS = 4
COLLECTOR_PREFIX = "collector-"
LOAD_BANDS = [
    ("morning", 6, 9, 1.3),
    ("evening", 18, 22, 1.5),
    ("night", 0, 6, 0.6),
]
OTHER_BAND = ("day", 1.0)


def meter_id(index: Column) -> Column:
    """Zero-padded to at least four digits; longer numbers stay whole.

    Padding is several times cheaper per row than a format string.
    """
    digits = index.cast("string")
    width = F.greatest(F.lit(METER_DIGITS), F.length(digits))
    return F.concat(F.lit(METER_PREFIX), F.lpad(digits, width, F.lit("0")))


def meter_index(identifier: Column) -> Column:
    """The number in a meter id; null if there is none."""
    return F.substring_index(identifier, "-", -1).try_cast("bigint")


def collector_id(shard: Column) -> Column:
    return F.concat(F.lit(COLLECTOR_PREFIX), (shard + 1).cast("string"))


def _check_shards(num: int) -> None:
    if num < 1:
        raise ValueError("the number of shards must be positive")


def meters_per_shard(total: Column, num: int) -> Column:
    """ceil(total / num) in whole numbers."""
    _check_shards(num)
    total = total.cast("bigint")
    return F.call_function("div", total + F.lit(num - 1), F.lit(num))


def with_shard(readings: DataFrame, total: Column | int, num: int) -> DataFrame:
    """Add `shard_id` by ranges of `meter_index`; no shuffle."""
    per = meters_per_shard(total if isinstance(total, Column) else F.lit(total), num)
    shard = F.call_function("div", F.col("meter_index"), F.greatest(per, F.lit(1)))
    return readings.withColumn("shard_id", shard.cast("int"))


def shard_ranges(spark: SparkSession, total: int, num: int) -> DataFrame:
    """(shard_id, start, end) of every shard that holds a meter."""
    per = meters_per_shard(F.lit(total), num)
    shards = spark.range(num).select(F.col("id").cast("int").alias("shard_id"), per.alias("per"))
    return shards.select(
        "shard_id",
        (F.col("shard_id") * F.col("per")).alias("start"),
        F.least((F.col("shard_id") + 1) * F.col("per"), F.lit(total)).alias("end"),
    ).filter(F.col("start") < total)


def meters_in_range(readings: DataFrame, start: int, end: int, total: int | None = None):
    """Meters start (incl.) to end (excl.), both clamped to 0..total."""
    low = max(start, 0)
    high = end if total is None else min(end, total)
    return readings.filter((F.col("meter_index") >= low) & (F.col("meter_index") < high))


def meter(readings: DataFrame, identifier: str) -> DataFrame:
    """The readings of one meter. Where its number is a column, that filter reaches the scan."""
    one = readings.filter(F.col("meter_id") == identifier)
    number = identifier.rpartition("-")[2]
    if "meter_index" in readings.columns and number.isascii() and number.isdigit():
        one = one.filter(F.col("meter_index") == int(number))
    return one


def write_order(readings: DataFrame) -> list[str]:
    """The columns that tell which of two readings was written later."""
    for columns in (["event_id"], ["ingest_order", "ingest_position"]):
        if set(columns) <= set(readings.columns):
            return columns
    raise ValueError("give the order: there is neither event_id nor an ingest order")


def _by_band(values: dict[str, object], hour: Column, other: object) -> Column:
    result = None
    for name, start, end, _ in LOAD_BANDS:
        inside = (hour >= start) & (hour < end)
        value = F.lit(values[name])
        result = F.when(inside, value) if result is None else result.when(inside, value)
    return result.otherwise(F.lit(other))


def with_load_band(readings: DataFrame) -> DataFrame:
    """Add the load band of the hour of day, its factor, and kwh with the factor taken out.

    The hour is that of the session time zone.
    """
    hour = F.hour("ts")
    return readings.withColumns(
        {
            "load_band": _by_band({b[0]: b[0] for b in LOAD_BANDS}, hour, OTHER_BAND[0]),
            "load_factor": _by_band({b[0]: b[3] for b in LOAD_BANDS}, hour, OTHER_BAND[1]),
        }
    ).withColumn("normal_kwh", F.col("kwh") / F.col("load_factor"))


def fill_current(readings: DataFrame) -> DataFrame:
    """Where current is null, derive it from energy and voltage."""
    derived = F.try_divide(F.col("kwh") * F.lit(1000.0), F.col("voltage"))
    return readings.withColumn("current", F.coalesce(F.col("current"), derived))


def instant(moment: dt.datetime | str | Column) -> Column:
    """A timestamp literal. A datetime or text without a zone is UTC."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(f"{moment.isoformat(sep=' ')} UTC").cast("timestamp")


def whole_second(moment: dt.datetime | str) -> dt.datetime:
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    return moment.replace(microsecond=0)


def to_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def to_rfc3339(ts: Column) -> Column:
    """Text with the offset of the session time zone, which is Z in UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def from_rfc3339(text: Column) -> Column:
    """Accepts offsets and up to nine decimals; keeps six. Null if it is no time."""
    return text.try_cast("timestamp")


def with_computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters use.

    Filters are pushed below a projection by repeating its expression, and JSON would be
    decoded again for each mention. The output of a generator is not repeated.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
