"""Readings to windows on a stream, with built-in aggregation.

The functions of the batch side are used on streaming frames; only the watermark is new.
Windows are emitted once the watermark has passed their end; later rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.rules import valid_only
from wattlake.operators.envelopes import dealt, dealt_facts, envelope_columns
from wattlake.operators.windows import metric_columns, tumble
from wattlake.schemas import SOURCE_KEYS

DELAY = "1 minute"


def metric_stream(
    readings: DataFrame, duration: str, delay: str = DELAY, exact: bool = False
) -> DataFrame:
    """Validate, and aggregate per window and meter: one flat row each."""
    return tumble(valid_only(readings).withWatermark("ts", delay), duration, exact)


def envelope_stream(
    readings: DataFrame, duration: str, delay: str = DELAY, parts: int = 1, exact: bool = False
) -> DataFrame:
    """Validate, aggregate per window and meter, and nest the meters of each window.

    The second level works on an aggregate, so it shuffles meters, not readings. `parts`
    splits an envelope by meter, to suit the message size and the memory of one task:
    choose it near (meters per shard) / 2000. Part 0 of a split window then has no metrics, but
    says in `whole` what the window has in all.
    """
    valid = valid_only(readings).withWatermark("ts", delay)
    window = F.window("ts", duration).alias("window")
    metrics = valid.groupBy(window, *SOURCE_KEYS, "meter_id").agg(*metric_columns(exact))
    rows = dealt(metrics, F.lit(parts), ["window", *SOURCE_KEYS])
    nested = rows.groupBy("window", *SOURCE_KEYS, "part").agg(*envelope_columns(False), dealt_facts(exact))
    return nested.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *SOURCE_KEYS,
        "total_count",
        "metrics",
        "part",
        "whole",
    )
