"""Connected components of links between numbered nodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.session import written


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    larger = both.where("b > a").join(least, F.col("a") == F.col("u"))
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    others = edges.join(least, F.col("a") == F.col("u")).where("b > m")
    others = others.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link to another: root is the smallest it reaches.

    `edges` has the bigint columns a and b; the order within a pair, repeated pairs and links of
    a node to itself don't matter. The two star steps alternate until nothing changes; each
    keeps the components and the number of edges is never more than the nodes and edges before.
    A node with many links costs an aggregate with map-side combining and a join whose large
    side can be split. Each round is written down, so that a lost executor costs one round.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = written(pairs.distinct(), "links")
    before = None
    while True:
        state = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        pairs = written(small_star(large_star(pairs)), "links")


def block_roots(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the nodes of rows and of columns the smallest node that links of a block connect.

    `linked` is a matrix of booleans. The smallest node is passed on along the links until
    nothing changes; one edge for each node says then what all links of the block say.
    """
    most = np.iinfo(np.int64).max
    root, far = rows.copy(), columns.copy()
    while True:
        to = np.minimum(far, np.where(linked, root[:, None], most).min(0, initial=most))
        back = np.minimum(root, np.where(linked, to[None], most).min(1, initial=most))
        if (to == far).all() and (back == root).all():
            return root, far
        root, far = back, to
