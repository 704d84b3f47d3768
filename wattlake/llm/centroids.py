"""Centroid clustering in whole numbers, with dot products that are kept and updated.

For each vector the products with all centroids are stored. When the centroids move, only their
components that changed are multiplied again; distances follow from the products and the squares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.session import written

#: Vectors that a worker handles at a time.
STEP = 4096
#: Components beyond this could take a distance past 64 bits.
LARGEST = 1 << 27


def whole(vectors: DataFrame, dims: int, scale: int, row_id: str, vector: str) -> DataFrame:
    """id, v (array of long) of the vectors that count: floor(scale * x) of each component.

    Vectors that are null, hold a null or a non-finite component or have another length are left
    out. A component beyond LARGEST is an error, since distances would pass 64 bits.
    """
    x = F.col(vector).cast(T.ArrayType(T.DoubleType()))
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    small = F.forall(x, lambda c: F.abs(c * F.lit(float(scale))) <= F.lit(float(LARGEST)))
    large = F.raise_error(F.lit("a component is too large for distances of 64 bits"))
    kept = vectors.where((F.size(x) == dims) & finite)
    return kept.select(
        F.col(row_id).cast("bigint").alias("id"), F.when(small, scaled).otherwise(large.cast("array<bigint>")).alias("v")
    )


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the smallest SHA-256 of `seed:id`, fewer if there are fewer vectors."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    start = rows.select("v", F.sha2(name.cast("binary"), 256).alias("h")).orderBy("h", "v").limit(k)
    return np.array([r.v for r in start.collect()], dtype=np.int64)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def nearest(v: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number on ties, and its squared distance."""
    distance = (v * v).sum(axis=1)[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(v)), cluster]


def updated(
    batches: Iterator[pa.RecordBatch], centroids: np.ndarray, before: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The products with moved centroids: what changed in each component is added."""
    k, dims = centroids.shape
    moves = centroids - before
    changed = [np.nonzero(row)[0] for row in moves]
    for batch in batches:
        for start in range(0, len(batch), STEP):
            part = batch.slice(start, STEP)
            v = matrix(part.column(1), dims)
            dots = matrix(part.column(2), k).copy() if part.num_columns > 2 else np.zeros((len(v), k), np.int64)
            for j, at in enumerate(changed):
                if len(at):
                    dots[:, j] += v[:, at] @ moves[j, at]
            cluster, distance = nearest(v, dots, centroids)
            found = [lists(dots), pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), lists(v), *found], names=["id", "v", "dots", "cluster", "distance"]
            )


def cluster_sums(batches: Iterator[pa.RecordBatch], k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Per partition and cluster: the number of vectors and the sums of their components."""
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for batch in batches:
        cluster = batch.column(1).to_numpy()
        v = matrix(batch.column(0), dims)
        for j in range(k):
            own = v[cluster == j]
            counts[j] += len(own)
            sums[j] += own.sum(axis=0)
    for j in np.nonzero(counts)[0].tolist():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(dims, j, np.int32)),
                pa.array(np.arange(dims, dtype=np.int32)),
                pa.array(np.full(dims, counts[j])),
                pa.array(sums[j]),
            ],
            names=["cluster", "place", "n", "total"],
        )


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of its vectors' mean; centroids without vectors stay.

    The sums over all partitions are decimals; they come to the driver as k x dims rows.
    """
    k, dims = centroids.shape
    local = state.select("v", "cluster").mapInArrow(
        partial(cluster_sums, k=k, dims=dims), "cluster int, place int, n bigint, total bigint"
    )
    sums = local.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    new = centroids.copy()
    for row in sums.collect():
        new[row.cluster, row.place] = int(row.total) // row.n
    return new


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: str = "1",
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Cluster vectors of `dims` components, as whole numbers floor(`scale` * x).

    The first centroids are the vectors with the smallest SHA-256 of `seed:id` (null id: `seed:`;
    equal ids in order of their components). In each round vectors go to the nearest centroid (ties:
    the smaller number), and centroids with vectors move to the floor of their mean; at the end
    vectors are assigned once more. With fewer than `k` vectors each is a centroid. Equal vectors
    have equal rows. Vectors that are null, of another length or with null or non-finite components
    are left out. Empty in, empty out. Other columns are not read.

    Returns the vectors (`row_id`, v, dots, cluster, distance) and the centroids (cluster, v, sha256).
    Nothing of the vectors is shuffled; the sums of each partition are.
    """
    spark = vectors.sparkSession
    rows = written(whole(vectors, dims, scale, row_id, vector), "whole-vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, dims)
    ddl = "id bigint, v array<bigint>, dots array<bigint>, cluster int, distance bigint"
    state, before = rows, np.zeros_like(centroids)
    for turn in range(rounds + 1):
        work = partial(updated, centroids=centroids, before=before)
        kept = state.select("id", "v", "dots") if turn else state
        state = written(kept.mapInArrow(work, ddl), "clusters")
        if turn < rounds:
            before, centroids = centroids, moved(state, centroids)
    table = spark.createDataFrame(
        [(j, c.tolist(), centroid_digest(c)) for j, c in enumerate(centroids)],
        "cluster int, v array<bigint>, sha256 string",
    )
    return state.withColumnRenamed("id", row_id), table


def cluster_report(vectors: DataFrame, row_id: str = "vec_id", **more) -> DataFrame:
    """`cluster_vectors` with one row per vector: cluster, distance, and the sums of distances."""
    state, centroids = cluster_vectors(vectors, row_id=row_id, **more)
    sums = state.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", sums.agg(F.sum("cluster_inertia")).scalar())
    about = centroids.select("cluster", F.col("sha256").alias("centroid_sha256")).join(sums, "cluster")
    found = state.select(row_id, "cluster", "distance").join(F.broadcast(about), "cluster")
    return found.select(row_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
