"""Centroid clustering against plain Python, round by round."""

import hashlib
import math
import random

import pytest

from wattlake.llm import centroids


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted((name(i), v) for i, v in kept)][:k]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        near = assigned()
        for j in range(len(c)):
            own = [v for (_, v), (_, at) in zip(kept, near) if at == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assigned()
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    sums = [sum(d for d, j in near if j == at) for at in range(len(c))]
    return [(i, j, d, sums[j], sum(sums), digest[j]) for (i, _), (d, j) in zip(kept, near)]


def frame(spark, rows, kind="float"):
    ddl = f"vec_id bigint, embedding array<{kind}>, id string, v string, cluster string, dots int"
    return spark.createDataFrame([(*r, "a", "b", "c", 1) for r in rows], ddl).repartition(3)


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("count,k", [(300, 16), (5, 16), (16, 16), (40, 3)])
def test_equals_brute_force(spark, count, k):
    rng = random.Random(count)
    rows = [(i, [rng.choice([-1, 0, 1]) * rng.randint(0, 40) / 32 for _ in range(8)]) for i in range(count)]
    rows += [rows[0]] * 3 + [(None, rows[1][1]), (None, None), (90, None), (91, []), (92, [1.0] * 7), (1, rows[2][1])]
    rows += [(93, [math.nan] + [0.0] * 7), (94, [math.inf] * 8), (95, [None] + [1.0] * 7), (96, [-math.inf] * 8)]
    got = centroids.cluster_report(frame(spark, rows), k=k, dims=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, k, 3, 8), key=key)


def test_products_are_those_of_the_last_centroids(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    state, table = centroids.cluster_vectors(frame(spark, rows, "double"), k=4, dims=6)
    last = {r.cluster: r.v for r in table.collect()}
    for r in state.collect():
        assert r.dots == [sum(a * b for a, b in zip(r.v, last[j])) for j in range(4)]


def test_empty(spark):
    got = centroids.cluster_report(frame(spark, []), dims=8)
    assert got.count() == 0 and got.columns[0] == "vec_id"


def test_components_that_cannot_be_handled(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_report(frame(spark, [(1, [1e30] * 8)], "double"), dims=8).count()
