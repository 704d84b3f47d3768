"""Histogram, distribution statistics and run comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.operators import ordered
from wattlake.operators.windows import total
from wattlake.session import written


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in `bins` equal intervals from the smallest to the largest value.

    The last interval includes its upper edge. Empty intervals have no row.
    """
    if bins < 1:
        raise ValueError("a histogram needs at least one bin")
    value = F.col(column)
    present = df.filter(value.isNotNull() & ~F.isnan(value))
    edges = present.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    low, width = F.col("_e.lo"), (F.col("_e.hi") - F.col("_e.lo")) / F.lit(float(bins))
    position = F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0))
    bin_number = F.least(position, F.lit(bins - 1)).cast("int")
    return (
        present.withColumn("_e", edges)
        .select(bin_number.alias("bin"), low.alias("_lo"), width.alias("_w"))
        .groupBy("bin", "_lo", "_w")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lower"),
            (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("upper"),
            "count",
        )
    )


def _parts(value: Column) -> tuple[Column, Column]:
    """The value if it is finite, and if it is NaN or infinite; null otherwise."""
    finite = F.abs(value) < float("inf")
    return F.when(finite, value), F.when(~finite, value)


def _weighted_sum(value: Column, weight: Column, exact: bool) -> Column:
    if not exact:
        return F.sum(value * weight)
    finite, other = _parts(value)
    exact_value = finite.cast("decimal(22,9)") * weight.cast("decimal(15,0)")
    return F.coalesce(F.sum(other * weight), F.sum(exact_value.cast("decimal(28,9)")).cast("double"))


def _mean_square(value: Column, weight: Column, exact: bool) -> Column:
    """The exact form takes values with nine decimals, as the exact sums do.

    A value is h hundredths and r billionths, all whole numbers, so that its square is
    h * h / 10^4 + 2 * h * r / 10^11 + r * r / 10^18.
    """
    if not exact:
        return F.sum(value * value * weight) / F.sum(weight)
    value, other = _parts(value)
    h = F.rint(value * 100.0).cast("decimal(18,0)")
    rest = value.cast("decimal(22,9)") - (h * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(20,2)")
    r = (rest.cast("decimal(18,9)") * F.lit(1_000_000_000).cast("decimal(10,0)")).cast("decimal(9,0)")
    n = weight.cast("decimal(18,0)")
    hh, hr, rr = (F.sum((x * y * n).cast("decimal(38,0)")).cast("double") for x, y in ((h, h), (h, r), (r, r)))
    total = F.coalesce(F.sum(other * other * weight), hh + 2.0 * hr / 1e7 + rr / 1e14)
    return total / F.sum(weight) / F.lit(10000.0)


def _pop_std(column: str | Column, exact: bool) -> Column:
    """Population standard deviation."""
    value = F.col(column) if isinstance(column, str) else column
    if not exact:
        return F.stddev_pop(value)
    one = F.when(value.isNotNull(), F.lit(1).cast("bigint"))
    mean = _weighted_sum(value, one, exact) / F.count(value)
    square = _mean_square(value, one, exact)
    return F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))


# The quantiles reported.
QUANTILES = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def _picked(wanted: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates that pick the values around each quantile's position, and what joins them."""
    picks, results = [], []
    for name, q in wanted.items():
        position = (F.col("_size") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (at < F.col("_upto")) & (at >= F.col("_upto") - F.col("_n"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}_{side}"))
        share = F.col(f"_{name}_share")
        picks.append(F.max(position - F.floor(position)).alias(f"_{name}_share"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((low * (1 - share) + high * share).alias(name))
    return picks, results


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    exact: bool = False,
    approximate: bool = False,
    group_rows: int = ordered.GROUP_ROWS,
) -> DataFrame:
    """Count, mean, median, population deviation, extremes, p95 and p99 per group.

    The quantiles are exact, with linear interpolation. Equal values are counted first, in
    one pass over the input; the counts are written down and all else comes from them. The
    running count says which value stands at which position, so that no task has to hold a
    group, as the built-in `percentile` would. Groups without values have no row.

    `approximate` takes the quantiles from sketches in a single aggregation instead.
    """
    value = F.col(column)
    if approximate:
        n = F.count(value)
        sketches = [F.percentile_approx(value, q).alias(name) for name, q in QUANTILES.items()]
        return df.filter(value.isNotNull()).groupBy(*keys).agg(
            n.alias("n"),
            (total(column, exact) / n).alias("mean"),
            _pop_std(column, exact).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            *sketches,
        )
    counted = written(
        df.filter(value.isNotNull())
        .groupBy(*keys, value.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "counted",
    )
    v, n = F.col("_v"), F.col("_n")
    sizes = counted.groupBy(*keys).agg(
        F.sum(n).alias("_size"),
        (_weighted_sum(v, n, exact) / F.sum(n)).alias("_mean"),
        _mean_square(v, n, exact).alias("_square"),
    )
    running = ordered.running_sum(counted, keys, ["_v"], n, "_upto", group_rows)
    if keys:
        on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        sized = running.alias("r").join(sizes.alias("s"), on).select(
            "r.*", "_size", "_mean", "_square"
        )
    else:
        facts = sizes.select(F.struct("_size", "_mean", "_square")).scalar()
        sized = running.withColumn("_f", facts).select("*", "_f.*")
    picks, quantiles = _picked(QUANTILES)
    spread = F.sum(n * (v - F.col("_mean")) * (v - F.col("_mean"))) / F.max("_size")
    if exact:
        spread = F.greatest(F.max(F.col("_square") - F.col("_mean") * F.col("_mean")), F.lit(0.0))
    return (
        sized.groupBy(*keys)
        .agg(
            F.max("_size").alias("n"),
            F.max("_mean").alias("mean"),
            F.sqrt(spread).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            *picks,
        )
        .select(*keys, "n", "mean", "std", "min", "max", *quantiles)
    )


RUN_MEASURES = ("readings_per_sec", "avg_us_per_read", "peak_mem_mb")


def compare_runs(
    runs: DataFrame,
    first: str,
    second: str,
    measures: Sequence[str] = RUN_MEASURES,
    exact: bool = False,
) -> DataFrame:
    """Mean and population deviation of each measure for two languages, side by side per
    number of meters, and the ratio of the means."""
    columns = []
    for m in measures:
        for label, language in (("a", first), ("b", second)):
            value = F.when(F.col("language") == language, F.col(m))
            one = F.when(value.isNotNull(), F.lit(1).cast("bigint"))
            mean = F.try_divide(_weighted_sum(value, one, exact), F.count(value))
            columns += [mean.alias(f"{m}_mean_{label}"), _pop_std(value, exact).alias(f"{m}_std_{label}")]
    both = (
        runs.filter(F.col("language").isin(first, second))
        .groupBy("meters")
        .agg(
            F.count_if(F.col("language") == first).alias("runs_a"),
            F.count_if(F.col("language") == second).alias("runs_b"),
            *columns,
        )
        .filter("runs_a > 0 and runs_b > 0")
    )
    ratios = [
        F.try_divide(F.col(f"{m}_mean_a"), F.col(f"{m}_mean_b")).alias(f"{m}_ratio")
        for m in measures
    ]
    return both.select("*", *ratios).orderBy("meters")


def comparison_range(compared: DataFrame, measures: Sequence[str] = RUN_MEASURES) -> DataFrame:
    """The smallest and largest ratio and means over all numbers of meters."""
    columns = []
    for m in measures:
        for c in (f"{m}_ratio", f"{m}_mean_a", f"{m}_mean_b"):
            columns += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return compared.agg(*columns)
