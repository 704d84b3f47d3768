"""Per-meter metrics in tumbling, counted and sliding windows.

Readings carry `meter_id, ts, kwh, voltage, current, shard_id, collector_id`; the
functions that depend on order also take the columns that make the order unique.
A metric table has one row per window and meter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlake.functions.columns import write_order
from wattlake.functions.rules import anomaly_code
from wattlake.operators import ordered
from wattlake.schemas import SOURCE_KEYS, window_keys

_MEASURES = [
    "count",
    "sum_kwh",
    "avg_kwh",
    "min_kwh",
    "max_kwh",
    "avg_voltage",
    "avg_current",
    "first_reading",
    "last_reading",
]


def seconds(duration: str, least: int = 1) -> int:
    """Whole seconds of a fixed duration such as '30 seconds' or '7 days'."""
    length = pd.Timedelta(duration)
    whole = int(length.total_seconds())
    if whole < least or pd.Timedelta(seconds=whole) != length:
        raise ValueError(f"not {least} or more whole seconds: {duration!r}")
    return whole


def time_order(readings: DataFrame) -> list[str]:
    """Time, and what makes it unique."""
    return ["ts", *write_order(readings)]


def exact_sum(value: str, scale: int = 9) -> str:
    """Sum as a decimal with `scale` decimals, as an SQL expression.

    Doubles give sums that depend on the order in which partitions arrive; decimals do not, and
    a re-run task gives the same result. There is room for values up to 10^19. NaN and infinities,
    which decimals don't have, are added up on their own: they give the same in any order, and
    where there are any they are the sum.
    """
    finite = f"abs({value}) < double('Infinity')"
    other = f"sum(case when {finite} then null else cast({value} as double) end)"
    whole = f"sum(cast(case when {finite} then {value} end as decimal(28, {scale})))"
    return f"coalesce({other}, cast({whole} as double))"


def total_sql(value: str, exact: bool = False) -> str:
    return exact_sum(value) if exact else f"sum({value})"


def total(value: str, exact: bool = False) -> Column:
    return F.expr(total_sql(value, exact))


def metric_columns(exact: bool = False) -> list[Column]:
    """The measures of one group of readings, all with map-side partial aggregation."""
    measures = {
        "count": "count(1)",
        "sum_kwh": total_sql("kwh", exact),
        "avg_kwh": f"{total_sql('kwh', exact)} / count(1)",
        "min_kwh": "min(kwh)",
        "max_kwh": "max(kwh)",
        "avg_voltage": f"{total_sql('voltage', exact)} / count(1)",
        "avg_current": f"{total_sql('current', exact)} / count(1)",
        "first_reading": "min(ts)",
        "last_reading": "max(ts)",
    }
    return [F.expr(measure).alias(name) for name, measure in measures.items()]


def aggregate_meters(readings: DataFrame, keys: Sequence[str], exact: bool = False) -> DataFrame:
    return readings.groupBy(*keys).agg(*metric_columns(exact))


def tumble(readings: DataFrame, duration: str, exact: bool = False) -> DataFrame:
    """One row per (window, source, meter); windows are aligned to the epoch."""
    window = F.window("ts", duration).alias("window")
    grouped = readings.groupBy(window, *SOURCE_KEYS, "meter_id").agg(*metric_columns(exact))
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *SOURCE_KEYS,
        "meter_id",
        *_MEASURES,
    )


def _counted(
    readings: DataFrame, keys: Sequence[str], n: int, order: Sequence[str] | None, exact: bool, group_rows: int
) -> DataFrame:
    """Metrics per (keys, window_seq, meter) where every n-th row of `keys` closes a window.

    `_full` tells whether the window reached n rows, `_from` and `_to` its first and last
    time. A window has at most n rows, so they can come from a window function.
    """
    order = order or time_order(readings)
    ranked = ordered.row_number(readings, keys, order, "_rank", group_rows)
    seq = F.call_function("div", F.col("_rank") - 1, F.lit(n))
    metrics = (
        ranked.withColumn("window_seq", seq)
        .groupBy(*keys, "window_seq", "meter_id")
        .agg(*metric_columns(exact))
    )
    whole = W.partitionBy(*keys, "window_seq")
    return metrics.withColumns(
        {
            "_full": F.sum("count").over(whole) == n,
            "_from": F.min("first_reading").over(whole),
            "_to": F.max("last_reading").over(whole),
        }
    )


def tumble_count(
    readings: DataFrame,
    n: int,
    order: Sequence[str] | None = None,
    exact: bool = False,
    group_rows: int = ordered.GROUP_ROWS,
) -> DataFrame:
    """Windows of n readings of a source, all meters together.

    The bounds are the times of the first and last reading in the window.
    """
    if n < 1:
        raise ValueError("a count window needs at least one reading")
    metrics = _counted(readings, SOURCE_KEYS, n, order, exact, group_rows)
    return metrics.select(
        F.col("_from").alias("window_start"),
        F.col("_to").alias("window_end"),
        "window_seq",
        *SOURCE_KEYS,
        "meter_id",
        *_MEASURES,
    )


def _whole_source(readings: DataFrame, exact: bool) -> DataFrame:
    """One window per source, from its first to its last reading."""
    metrics = aggregate_meters(readings, [*SOURCE_KEYS, "meter_id"], exact)
    bounds = readings.groupBy(*SOURCE_KEYS).agg(
        F.min("ts").alias("window_start"), F.max("ts").alias("window_end")
    )
    return metrics.join(bounds, SOURCE_KEYS).select(
        "window_start",
        "window_end",
        F.lit(0).cast("bigint").alias("window_seq"),
        *SOURCE_KEYS,
        "meter_id",
        *_MEASURES,
    )


def tumble_hybrid(
    readings: DataFrame,
    duration: str | None,
    n: int,
    order: Sequence[str] | None = None,
    exact: bool = False,
    group_rows: int = ordered.GROUP_ROWS,
) -> DataFrame:
    """Time-or-count windows: counted windows nested in aligned time windows.

    The time trigger keeps its period when a count closes a window. No duration or n = 0
    switches that trigger off; with both off, each source has one window. A window closed
    by the count ends at its last reading, one closed by time at the end of the period.
    The first window of a period starts with it, the others at their first reading.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if duration is None:
        if n:
            return tumble_count(readings, n, order, exact, group_rows)
        return _whole_source(readings, exact)
    if not n:
        return tumble(readings, duration, exact).withColumn(
            "window_seq", F.lit(0).cast("bigint")
        )
    bucketed = readings.withColumn("_bucket", F.window("ts", duration))
    metrics = _counted(
        bucketed.select("*", F.col("_bucket.start").alias("_start")).drop("_bucket"),
        [*SOURCE_KEYS, "_start"],
        n,
        order,
        exact,
        group_rows,
    )
    return hybrid_bounds(metrics, duration)


def hybrid_bounds(metrics: DataFrame, duration: str | None) -> DataFrame:
    """Time-or-count windows with their bounds, from metrics with `_start`, `_full`, `_from`, `_to`."""
    start, end = F.col("_from"), F.col("_to")
    if duration is not None:
        over = F.col("_start") + F.expr(f"interval {seconds(duration)} seconds")
        start = F.when(F.col("window_seq") == 0, F.col("_start")).otherwise(start)
        end = F.when(F.col("_full"), end).otherwise(over)
    return metrics.select(
        start.alias("window_start"),
        end.alias("window_end"),
        "window_seq",
        *SOURCE_KEYS,
        "meter_id",
        *_MEASURES,
    )


def contiguous_bounds(
    windows: DataFrame, group_rows: int = ordered.GROUP_ROWS
) -> DataFrame:
    """Let each window of a source start where the previous emitted one ended.

    Takes one row per window. The first window of a source keeps its start.
    """
    order = [c for c in window_keys(windows) if c not in SOURCE_KEYS]
    order.sort(key=lambda c: c != "window_end")
    linked = ordered.previous(windows, SOURCE_KEYS, order, ["window_end"], "_prev", group_rows)
    start = F.coalesce(F.col("_prev.window_end"), F.col("window_start"))
    return linked.withColumn("window_start", start).drop("_prev")


def with_anomaly(
    readings: DataFrame,
    order: Sequence[str] | None = None,
    nan: str = "reject",
    group_rows: int = ordered.GROUP_ROWS,
) -> DataFrame:
    """Add `anomaly_code`, which compares each reading with the one before of its meter."""
    order = order or time_order(readings)
    linked = ordered.previous(
        readings, ["meter_id"], order, ["kwh", "voltage"], "_prev", group_rows
    )
    code = anomaly_code("_prev", nan)
    return linked.withColumn("anomaly_code", code).drop("_prev")


def slide(
    readings: DataFrame, duration: str, step: str, exact: bool = False
) -> DataFrame:
    """Every `step`, the readings of the last `duration`: totals and active meters.

    A reading lies in duration/step windows. Readings are first reduced to one row per meter
    and pane (the longest period that divides both). A pane counts its meter as active in
    those of its windows that the meter's previous pane is not in, so each window counts a
    meter once, and windows are summed without regard to meters: copies of panes are added
    up before anything is shuffled. A meter has at most one row per pane, which bounds what
    the window function sees, whatever its number of readings.
    """
    length, hop = seconds(duration), seconds(step)
    if hop > length:
        raise ValueError("the step must not exceed the duration")
    pane = math.gcd(length, hop)
    kwh = F.col("kwh").cast("decimal(28,9)") if exact else F.col("kwh")
    panes = readings.groupBy(F.window("ts", f"{pane} seconds").alias("pane"), "meter_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(kwh).alias("kwh"),
        F.min("kwh").alias("low"),
        F.max("kwh").alias("high"),
    )
    begin = F.unix_seconds("pane.start")
    # The last window that holds a pane starts at the multiple of the step at or before it;
    # the first is the earliest multiple whose window reaches the end of the pane.
    last = begin - F.pmod(begin, F.lit(hop))
    earliest = begin + pane - length
    first = earliest + F.pmod(-earliest, F.lit(hop))
    starts = F.sequence(first, last, F.lit(hop).cast("bigint"))
    covered = F.lag(last).over(W.partitionBy("meter_id").orderBy("pane.start"))
    copies = panes.withColumn("_covered", covered).select(
        F.explode(starts).alias("start"), "_covered", "n", "kwh", "low", "high"
    )
    energy = F.sum("kwh").cast("double") if exact else F.sum("kwh")
    return (
        copies.groupBy("start")
        .agg(
            F.sum("n").alias("count"),
            energy.alias("sum_kwh"),
            F.min("low").alias("min_kwh"),
            F.max("high").alias("max_kwh"),
            F.count_if(F.col("_covered").isNull() | (F.col("start") > F.col("_covered"))).alias(
                "active_meters"
            ),
        )
        .select(
            F.timestamp_seconds("start").alias("window_start"),
            F.timestamp_seconds(F.col("start") + length).alias("window_end"),
            "count",
            "sum_kwh",
            (F.col("sum_kwh") / F.col("count")).alias("avg_kwh"),
            "min_kwh",
            "max_kwh",
            "active_meters",
        )
    )


def latest_n(windows: DataFrame, n: int = 500) -> DataFrame:
    """The n windows with the latest end. Ties break by source and start."""
    order = [F.col("window_end").desc()]
    order += [F.col(c) for c in window_keys(windows) if c != "window_end"]
    return windows.orderBy(*order).limit(n)
