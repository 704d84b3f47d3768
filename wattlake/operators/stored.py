"""Keyed storage of readings and the two range reads over it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.columns import instant, meter, whole_second, write_order


def upsert_latest(
    readings: DataFrame, grain: str = "second", order: Sequence[str] | None = None
) -> DataFrame:
    """One reading per meter and `grain` of time: the last one written, by `order`.

    By default that is the event's number, or the order in which the store got it. An aggregate,
    not a ranking: losers are dropped before the shuffle, however many readings one meter has in
    one grain. It sorts by key on both sides of the shuffle, as a row is no fixed-width value.
    """
    order = order or write_order(readings)
    others = [c for c in readings.columns if c != "meter_id"]
    slot = F.date_trunc(grain, "ts").alias("_slot")
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("_last")
    return readings.groupBy("meter_id", slot).agg(last).select(
        *[f"_last.{c}" if c in others else c for c in readings.columns]
    )


def _on_days(readings: DataFrame, start: Column, end: Column) -> DataFrame:
    """Prune partitions where the table is laid out by date."""
    if "date" not in readings.columns:
        return readings
    return readings.filter(F.col("date").between(F.to_date(start), F.to_date(end)))


def readings_for_meter(
    readings: DataFrame, meter_id: str, start: dt.datetime | str, end: dt.datetime | str
) -> DataFrame:
    """One meter, from `start` (incl.) to `end` (excl.), both cut to the whole second.

    The bounds are cut, not the column: the filter reaches the scan.
    """
    low, high = instant(whole_second(start)), instant(whole_second(end))
    one = meter(readings, meter_id)
    return _on_days(one, low, high).filter((F.col("ts") >= low) & (F.col("ts") < high))


def readings_between(
    readings: DataFrame, start: dt.datetime | str, end: dt.datetime | str
) -> DataFrame:
    """All meters, strictly after `start` and strictly before `end`."""
    low, high = instant(start), instant(end)
    return _on_days(readings, low, high).filter((F.col("ts") > low) & (F.col("ts") < high))
