"""Exact ranks within groups of any size, with built-in functions only.

A window over a whole group would hand a group that has a third of all rows to one task. Here
rows carry an even order value in [0, 1) (a hash, or a fraction that is even by construction);
it cuts each group into buckets, rows are numbered inside (group, bucket), and the sizes of the
buckets before are added. The buckets' sizes are one row per bucket.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Rows that a bucket holds on average if all rows are in one group, and the most buckets of a
#: group (each is a row of a running sum). They set how finely the work is cut, never a rank.
BUCKET_ROWS = 2_000
MAX_BUCKETS = 100_000


def even(value: Column) -> Column:
    """An order value in [0, 1) from the first 32 bits of the MD5 of `value` as text.

    Null counts as an empty text.
    """
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ranked(
    rows: DataFrame, group: list[str], order: str, ties: list[str], rank: str, size: str
) -> DataFrame:
    """Add `rank` (from 0, long) and `size` (rows of the group, long).

    `order` names a column of doubles in [0, 1); equal values follow `ties`, nulls first. A null
    in `group` is a group of its own. `rows` is read twice, so it should be a written table. An
    empty input gives an empty result.
    """
    buckets = min(MAX_BUCKETS, max(1, ceil(rows.count() / BUCKET_ROWS)))
    keys = [*group, "_bucket"]
    cut = rows.withColumn("_bucket", F.floor(F.col(order) * buckets).cast("int"))
    before = W.Window.partitionBy(*group).orderBy("_bucket")
    before = before.rowsBetween(W.Window.unboundedPreceding, -1)
    sizes = (
        cut.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn(size, F.sum("_rows").over(W.Window.partitionBy(*group)))
        .select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_before", size)
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    inside = W.Window.partitionBy(*keys).orderBy(order, *ties)
    return (
        cut.withColumn("_inside", F.row_number().over(inside))
        .join(sizes, same)
        .withColumn(rank, F.col("_before") + F.col("_inside") - 1)
        .drop("_inside", "_before", "_bucket", *[f"_key_{k}" for k in keys])
    )
