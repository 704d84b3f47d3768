"""Row numbers, running sums and previous rows for groups of any size.

A window function sends a whole group to one task. That is the right plan while the
groups are small, so their sizes are counted first (a map-side aggregate of the keys). If there
are groups larger than `group_rows`, the input is written down once, and their rows are
range-partitioned by keys and order instead, which cuts a group wherever it is too long, even among rows of the same time. Every run of
rows then gets its window function on its own, and what the earlier runs of the same group
hand on (a total, or a last row) is one row per run.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlake.session import written

GROUP_ROWS = 5_000_000
#: Rows of a run, where there are more of them than shuffle partitions. `group_rows` says which
#: groups are cut; runs as short as small groups would be a task and a file each.
RUN_ROWS = 500_000
RUN = "_run"


class _Sizes(NamedTuple):
    large_groups: int
    large_rows: int


def _sizes(df: DataFrame, keys: Sequence[str], group_rows: int) -> _Sizes:
    large = F.col("count") > group_rows
    counts = df.groupBy(*keys).count()
    row = counts.agg(F.count_if(large), F.sum(F.when(large, F.col("count"))))
    return _Sizes(*[value or 0 for value in row.first()])


def _same(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    """Equal keys; null is a group of its own."""
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def _runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], wanted: int) -> DataFrame:
    """`df` with a run number that grows with the order.

    The run number depends on the sampled bounds of this one shuffle, so it is written down
    before anything else uses it.
    """
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(max(wanted, shuffled), *keys, *order)
    return written(ranged.withColumn(RUN, F.spark_partition_id()), "runs")


def _by_size(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    group_rows: int,
    whole: Callable[[DataFrame], DataFrame],
    in_runs: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """`whole` for the groups that fit one task, `in_runs` for the others."""
    sizes = _sizes(df, keys, group_rows)
    if not sizes.large_groups:
        return whole(df)
    wanted = math.ceil(sizes.large_rows / max(group_rows, RUN_ROWS))
    if not keys:  # all rows are the one large group
        return in_runs(_runs(df, keys, order, wanted))
    stored = written(df, "ordered-rows")
    large = stored.groupBy(*keys).count().filter(F.col("count") > group_rows).select(*keys)
    rows, groups = stored.alias("r"), written(large, "large-groups").alias("g")
    small = rows.join(groups, _same("r", "g", keys), "left_anti")
    rest = rows.join(groups, _same("r", "g", keys), "left_semi")
    return whole(small).unionByName(in_runs(_runs(rest, keys, order, wanted)))


def _with_carry(runs: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the carry.

    Only the first group of a run can have begun in an earlier one, so the carry has
    at most one row per run, that is, per shuffle partition: small enough to broadcast.
    """
    on = [*_same("r", "c", keys), F.col(f"r.{RUN}") == F.col(f"c.{RUN}")]
    continued = F.broadcast(carry.filter("_carry is not null"))
    return runs.alias("r").join(continued.alias("c"), on, "left").select("r.*", "c._carry")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    name: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the sum of `weight` over the rows of the group up to and including this one.

    `order` must be unique within a group.
    """

    def so_far(*groups: str) -> Column:
        frame = W.partitionBy(*groups).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return F.sum(weight).over(frame)

    def whole(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, so_far(*keys))

    def in_runs(runs: DataFrame) -> DataFrame:
        earlier = W.partitionBy(*keys).orderBy(RUN).rowsBetween(W.unboundedPreceding, -1)
        totals = runs.groupBy(*keys, RUN).agg(F.sum(weight).alias("_total"))
        carry = totals.withColumn("_carry", F.sum("_total").over(earlier)).drop("_total")
        summed = _with_carry(runs.withColumn(name, so_far(*keys, RUN)), carry, keys)
        # Null only where the run and what came before it have nothing to add.
        total = F.coalesce(F.col(name) + F.col("_carry"), F.col(name), F.col("_carry"))
        return summed.withColumn(name, total).drop(RUN, "_carry")

    return _by_size(df, keys, order, group_rows, whole, in_runs)


def row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the position, from 1, of each row in its group. `order` must be unique there."""
    return running_sum(df, keys, order, F.lit(1).cast("bigint"), name, group_rows)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    name: str,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add a struct of `columns` of the row before; null for the first row of a group."""
    row = F.struct(*columns)

    def before(*groups: str) -> Column:
        return F.lag(row).over(W.partitionBy(*groups).orderBy(*order))

    def whole(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, before(*keys))

    def in_runs(runs: DataFrame) -> DataFrame:
        last = F.max_by(row, F.struct(*order)).alias("_last")
        earlier = F.lag("_last").over(W.partitionBy(*keys).orderBy(RUN))
        lasts = runs.groupBy(*keys, RUN).agg(last)
        carry = lasts.withColumn("_carry", earlier).drop("_last")
        linked = _with_carry(runs.withColumn(name, before(*keys, RUN)), carry, keys)
        return linked.withColumn(name, F.coalesce(name, "_carry")).drop(RUN, "_carry")

    return _by_size(df, keys, order, group_rows, whole, in_runs)
