"""Reports over a stream of envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators.envelopes import apply_defaults, explode_metrics, with_envelope_totals
from wattlake.operators.rollups import merge_columns, readings_per_sec, report_columns
from wattlake.operators.windows import total

INTERVAL = "30 seconds"


def report_stream(
    envelopes: DataFrame, interval: str = INTERVAL, delay: str = "1 minute", exact: bool = False
) -> DataFrame:
    """An energy report per interval of window ends, each starting from nothing.

    Distinct counts are not allowed on a stream. The first level has one row per meter, so
    that counting its rows counts the active meters exactly; the first metric of an envelope
    carries its window, and an envelope without metrics keeps one row to do so.
    """
    known = apply_defaults(envelopes)
    named = F.filter("metrics", lambda m: F.coalesce(m["meter_id"], F.lit("")) != "")
    rows = known.withWatermark("window_end", delay).select(
        "window_end", "part", F.posexplode_outer(named).alias("_pos", "_m")
    )
    counts_window = (F.coalesce("_pos", F.lit(0)) == 0) & (F.coalesce("part", F.lit(0)) == 0)
    flat = rows.select("window_end", counts_window.cast("bigint").alias("_first"), "_m.*")
    per_meter = flat.groupBy(F.window("window_end", interval).alias("window"), "meter_id").agg(
        F.sum("_first").alias("_windows"), *merge_columns(exact)
    )
    report = per_meter.groupBy("window").agg(
        F.sum("_windows").alias("windows"), *report_columns(exact)
    )
    return report.select(
        F.col("window.start").alias("interval_start"),
        F.col("window.end").alias("interval_end"),
        readings_per_sec(F.col("total_readings"), interval).alias("readings_per_sec"),
        *[c for c in report.columns if c != "window"],
    )


def collector_totals(envelopes: DataFrame) -> DataFrame:
    """Windows, readings and energy per collector since the start (complete or update mode)."""
    known = with_envelope_totals(apply_defaults(envelopes))
    return known.groupBy("collector_id").agg(
        F.count_if(F.coalesce("part", F.lit(0)) == 0).alias("windows"),
        F.sum("total_count").alias("readings"),
        F.sum("total_kwh").alias("total_kwh"),
    )


def meter_totals(envelopes: DataFrame, exact: bool = False) -> DataFrame:
    """Count, energy and extremes per meter since the start (complete or update mode).

    The state has one row per meter, however many readings there are. In update mode, a batch has the
    meters that changed, which `run.BucketTable` merges into a table.
    """
    rows = explode_metrics(apply_defaults(envelopes))
    return rows.groupBy("meter_id").agg(
        F.sum("count").alias("count"),
        total("sum_kwh", exact).alias("sum_kwh"),
        F.min("min_kwh").alias("min_kwh"),
        F.max("max_kwh").alias("max_kwh"),
    )
