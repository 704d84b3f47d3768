"""Reports from metric tables (one row per window and meter) and window summaries
(one row per window). With `exact`, sums are taken at fixed decimals (see `exact_sum`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.columns import instant
from wattlake.functions.rules import with_validation
from wattlake.operators.envelopes import UNKNOWN_COLLECTOR, first_parts, summarize
from wattlake.operators.windows import latest_n, seconds, total
from wattlake.schemas import window_keys


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _ratio(top: Column, bottom: Column) -> Column:
    return _or_zero(F.try_divide(top, bottom))


def _span_seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


# --- merging pre-aggregates ---------------------------------------------------------


def merge_columns(exact: bool = False) -> list[Column]:
    """Sums that give back what the readings themselves would have given."""
    return [
        F.sum("count").alias("count"),
        total("sum_kwh", exact).alias("sum_kwh"),
        F.min("min_kwh").alias("min_kwh"),
        F.max("max_kwh").alias("max_kwh"),
        total("avg_voltage * count", exact).alias("sum_voltage"),
        total("avg_current * count", exact).alias("sum_current"),
    ]


def merge_metrics(
    metrics: DataFrame, keys: Sequence[str] = ("meter_id",), exact: bool = False
) -> DataFrame:
    return metrics.groupBy(*keys).agg(*merge_columns(exact))


def report_columns(exact: bool = False) -> list[Column]:
    """Totals over merged meters; averages weigh each meter by its readings."""
    return [
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("total_readings"),
        F.count("meter_id").alias("active_meters"),
        *_report_measures("sum_voltage", "sum_current", exact),
    ]


def _report_measures(voltage: str, current: str, exact: bool) -> list[Column]:
    n = F.sum("count")
    return [
        _or_zero(total("sum_kwh", exact)).alias("total_kwh"),
        _ratio(total("sum_kwh", exact), n).alias("weighted_avg_kwh"),
        _or_zero(F.min("min_kwh")).alias("min_kwh"),
        _or_zero(F.max("max_kwh")).alias("max_kwh"),
        _ratio(total(voltage, exact), n).alias("weighted_avg_voltage"),
        _ratio(total(current, exact), n).alias("weighted_avg_current"),
    ]


def _one_pass_report(metrics: DataFrame, exact: bool) -> list[Column]:
    """Windows, meters and totals in one aggregate.

    Distinct counts copy each metric row per count, but the copies are reduced to distinct
    keys before they are shuffled; a second pass would read the readings again.
    """
    measures = _report_measures("avg_voltage * count", "avg_current * count", exact)
    return [
        F.count_distinct(F.struct(*window_keys(metrics))).alias("windows"),
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("total_readings"),
        F.count_distinct("meter_id").alias("active_meters"),
        *measures,
    ]


def energy_report(
    metrics: DataFrame, elapsed: float | None = None, exact: bool = False
) -> DataFrame:
    """One row over everything; zeros when there is nothing.

    `elapsed` is in seconds, by default the time that the windows span.
    """
    span = _span_seconds(F.min("window_start"), F.max("window_end"))
    time = span if elapsed is None else F.lit(float(elapsed))
    rate = _ratio(F.sum("count"), time).alias("readings_per_sec")
    return metrics.agg(*_one_pass_report(metrics, exact), rate)


def flat_summary(metrics: DataFrame, exact: bool = False) -> DataFrame:
    """One row over a flat table; its means do not weight rows by their readings.

    Rows are first reduced to (collector, meter), over which both distinct counts are cheap.
    """
    averages = ["avg_kwh", "avg_voltage", "avg_current"]
    pairs = metrics.groupBy("collector_id", "meter_id").agg(
        F.count(F.lit(1)).alias("n"),
        total("sum_kwh", exact).alias("sum_kwh"),
        *[(F.count(a)).alias(f"n_{a}") for a in averages],
        *[_mean_part(a, exact).alias(a) for a in averages],
        F.min("min_kwh").alias("min_kwh"),
        F.max("max_kwh").alias("max_kwh"),
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_rows"),
        F.count_distinct("collector_id").alias("collectors"),
        F.count_distinct("meter_id").alias("meters"),
        _or_zero(total("sum_kwh", exact)).alias("total_kwh"),
        *[_mean_whole(a, exact).alias(f"mean_of_{a}") for a in averages],
        F.min("min_kwh").alias("min_kwh"),
        F.max("max_kwh").alias("max_kwh"),
    )


def _mean_part(name: str, exact: bool) -> Column:
    return F.sum(F.col(name).cast("decimal(28,9)") if exact else F.col(name))


def _mean_whole(name: str, exact: bool) -> Column:
    amount = F.sum(name).cast("double") if exact else F.sum(name)
    return F.try_divide(amount, F.sum(f"n_{name}"))


def by_collector(metrics: DataFrame, exact: bool = False) -> DataFrame:
    """Energy, readings and meters per collector, in order of collector.

    The (collector, meter) level spreads a collector that has most of the rows.
    """
    pairs = metrics.groupBy("collector_id", "meter_id").agg(
        total("sum_kwh", exact).alias("sum_kwh"), F.sum("count").alias("count")
    )
    return (
        pairs.groupBy("collector_id")
        .agg(
            total("sum_kwh", exact).alias("sum_kwh"),
            F.sum("count").alias("count"),
            F.count("meter_id").alias("meters"),
        )
        .orderBy("collector_id")
    )


# --- dashboard ----------------------------------------------------------------------


def kpis(
    metrics: DataFrame,
    n: int = 500,
    as_of: dt.datetime | str | None = None,
    exact: bool = False,
) -> DataFrame:
    """One row of headline figures.

    `retained_kwh` covers the n latest windows, `total_kwh` all of them. The rate divides
    all readings by the time from the oldest retained window to `as_of` (by default the
    end of the latest window). Reads the metrics three times: give it a stored table.
    """
    windows = summarize(metrics, exact)
    points = latest_n(windows, n).agg(
        F.struct(
            _or_zero(total("total_kwh", exact)).alias("kwh"),
            F.count(F.lit(1)).alias("n"),
            F.min("window_end").alias("oldest"),
        )
    )
    meters = metrics.groupBy("meter_id").count().agg(F.count("meter_id"))
    last = F.max("window_end")
    totals = windows.agg(
        F.coalesce(F.sum("total_count"), F.lit(0).cast("bigint")).alias("total_readings"),
        _or_zero(total("total_kwh", exact)).alias("total_kwh"),
        F.count(F.lit(1)).alias("windows_received"),
        last.alias("last_update"),
    )
    now = F.col("last_update") if as_of is None else instant(as_of)
    return (
        totals.withColumn("_p", points.scalar())
        .withColumn("active_meters", meters.scalar())
        .select(
            "total_readings",
            "active_meters",
            F.col("_p.kwh").alias("retained_kwh"),
            "total_kwh",
            _ratio(F.col("total_readings"), _span_seconds(F.col("_p.oldest"), now)).alias(
                "readings_per_sec"
            ),
            "windows_received",
            F.col("_p.n").alias("retained_points"),
            "last_update",
        )
    )


def collector_stats(windows: DataFrame, exact: bool = False) -> DataFrame:
    """Windows, readings and energy (two decimals) per collector since the start."""
    name = F.coalesce("collector_id", F.lit(UNKNOWN_COLLECTOR)).alias("collector_id")
    return windows.groupBy(name).agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("total_count").alias("readings"),
        F.round(total("total_kwh", exact), 2).alias("total_kwh"),
    )


def _meter_totals(metrics: DataFrame, exact: bool) -> DataFrame:
    return metrics.groupBy("meter_id").agg(
        total("sum_kwh", exact).alias("_kwh"),
        F.sum("count").alias("readings"),
        F.min("min_kwh").alias("min_kwh"),
        F.max("max_kwh").alias("max_kwh"),
    )


def meter_table(metrics: DataFrame, exact: bool = False) -> DataFrame:
    """Average (four decimals) and total energy (two) per meter, largest total first."""
    order = [F.col("_kwh").desc(), F.col("meter_id")]
    return (
        _meter_totals(metrics, exact)
        .orderBy(*order)
        .select(
            "meter_id",
            F.round(F.try_divide(F.col("_kwh"), F.col("readings")), 4).alias("avg_kwh"),
            F.round("_kwh", 2).alias("total_kwh"),
            "readings",
            "min_kwh",
            "max_kwh",
        )
    )


def top_meters(metrics: DataFrame, k: int, exact: bool = False) -> DataFrame:
    """The k meters with the most energy; each task keeps k, nothing is sorted whole."""
    return meter_table(metrics, exact).limit(k)


def reading_rate(windows: DataFrame, n: int = 500) -> DataFrame:
    """Readings and windows per collector among the n latest windows."""
    return (
        latest_n(windows, n)
        .groupBy("collector_id")
        .agg(F.sum("total_count").alias("readings"), F.count(F.lit(1)).alias("windows"))
    )


def energy_series(windows: DataFrame, n: int = 500) -> DataFrame:
    """The n latest windows as points of one line per collector."""
    return (
        latest_n(windows, n)
        .select(
            F.col("window_end").alias("time"),
            F.col("collector_id").alias("collector"),
            F.col("total_count").alias("readings"),
            "total_kwh",
            "num_meters",
        )
        .orderBy("collector", "time")
    )


# --- intake -------------------------------------------------------------------------


def service_stats(windows: DataFrame) -> DataFrame:
    """Windows and readings, of windows or of envelopes (a split window counts once)."""
    first = F.coalesce("part", F.lit(0)) == 0 if "part" in windows.columns else F.lit(True)
    return windows.agg(
        F.count_if(first).alias("total_windows"),
        F.coalesce(F.sum("total_count"), F.lit(0).cast("bigint")).alias("total_readings"),
    )


def windows_per_collector(windows: DataFrame) -> DataFrame:
    """Windows without a collector id are left out here."""
    named = first_parts(windows).filter("collector_id is not null and collector_id <> ''")
    return named.groupBy("collector_id").agg(F.count(F.lit(1)).alias("windows"))


def latest_window(windows: DataFrame, arrival: Sequence[str] = ("received_at",)) -> DataFrame:
    """The window that arrived last; of those that arrived together, the one that ended last.

    Windows that also ended together follow the order of their shard and collector.
    """
    windows = first_parts(windows)
    ties = ("window_end", "window_start", "window_seq", "shard_id", "collector_id")
    order = [*arrival, *[c for c in ties if c in windows.columns and c not in arrival]]
    row = F.max_by(F.struct(*windows.columns), F.struct(*order)).alias("_w")
    return windows.agg(row).filter("_w is not null").select("_w.*")


def dataset_info(windows: DataFrame) -> DataFrame:
    """The size of a dataset in windows: neither in metrics nor in parts of split windows."""
    return first_parts(windows).agg(F.count(F.lit(1)).alias("total_records"))


def active_collectors(
    windows: DataFrame, as_of: dt.datetime | str | None = None, ttl: str = "10 seconds"
) -> DataFrame:
    """Collectors seen within `ttl` before `as_of` (by default the latest window), with
    the shard they last reported."""
    seen = windows.groupBy("collector_id").agg(
        F.max_by("shard_id", F.struct("window_end", "shard_id")).alias("shard_id"),
        F.max("window_end").alias("last_seen"),
    )
    now = seen.agg(F.max("last_seen")).scalar() if as_of is None else instant(as_of)
    age = _span_seconds(F.col("last_seen"), F.col("_now"))
    return (
        seen.withColumn("_now", now)
        .filter(age <= float(seconds(ttl, least=0)))
        .select("collector_id", "shard_id", "last_seen")
    )


# --- readings -----------------------------------------------------------------------


def validation_counts(readings: DataFrame, nan: str = "reject") -> DataFrame:
    """Readings collected, valid and invalid per collector, and the invalid ones by code."""
    checked = readings if "error_code" in readings.columns else with_validation(readings, nan)
    code = F.col("error_code")
    return checked.groupBy("collector_id").agg(
        F.count(F.lit(1)).alias("collected"),
        F.count_if(code == 0).alias("valid"),
        F.count_if(code != 0).alias("invalid"),
        *[F.count_if(code == c).alias(f"code_{c}") for c in (1, 2, 3, 4)],
        F.count_if(code == -1).alias("no_input"),
    )


def throughput(metrics: DataFrame) -> DataFrame:
    """Readings per second and microseconds per reading over the time of the readings,
    and the number of closed windows."""
    facts = metrics.agg(
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("total_readings"),
        _span_seconds(F.min("first_reading"), F.max("last_reading")).alias("elapsed_seconds"),
        F.count_distinct(F.struct(*window_keys(metrics))).alias("windows"),
    )
    return facts.select(
        "total_readings",
        "elapsed_seconds",
        _ratio(F.col("total_readings"), F.col("elapsed_seconds")).alias("readings_per_sec"),
        _ratio(F.col("elapsed_seconds") * 1e6, F.col("total_readings")).alias("us_per_reading"),
        "windows",
    )


def readings_per_sec(readings: Column, interval: str) -> Column:
    """Readings of a report over the length of its interval."""
    return readings / F.lit(float(seconds(interval)))


def periodic_report(metrics: DataFrame, interval: str, exact: bool = False) -> DataFrame:
    """An energy report per interval of window ends, each starting from nothing.

    An end on a boundary belongs to the interval that begins there. The streaming form is
    `streaming.reports.report_stream`.
    """
    keyed = metrics.groupBy(F.window("window_end", interval).alias("_iv"))
    return keyed.agg(*_one_pass_report(metrics, exact)).select(
        F.col("_iv.start").alias("interval_start"),
        F.col("_iv.end").alias("interval_end"),
        "windows",
        "total_readings",
        readings_per_sec(F.col("total_readings"), interval).alias("readings_per_sec"),
        "active_meters",
        "total_kwh",
        "weighted_avg_kwh",
        "min_kwh",
        "max_kwh",
        "weighted_avg_voltage",
        "weighted_avg_current",
    )
