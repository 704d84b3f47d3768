"""Row numbers, running sums and previous rows against brute force, with split groups."""

import random

import pytest
from pyspark.sql import functions as F

from wattlake.operators import ordered


def rows(seed=1, n=3000):
    """One key has a third of the rows, and one time of it has a third of those."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        when = 500 if key == "hot" and rng.random() < 0.34 else rng.randrange(1000)
        data.append((i, key, when, rng.choice([None, 1.5, 2.5, 3.5])))
    return data


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "id bigint, k string, t bigint, v double").repartition(5)


def brute():
    groups = {}
    for row in rows():
        groups.setdefault(row[1], []).append(row)
    numbers, sums, before = {}, {}, {}
    for group in groups.values():
        total, last = 0, None
        for position, row in enumerate(sorted(group, key=lambda r: (r[2], r[0])), 1):
            total += row[2]
            numbers[row[0]], sums[row[0]], before[row[0]] = position, total, last
            last = (row[3], row[0])
    return numbers, sums, before


@pytest.mark.parametrize("group_rows", [200, 600, 10**6])
def test_against_brute_force(frame, group_rows):
    numbers, sums, before = brute()
    got = ordered.row_number(frame, ["k"], ["t", "id"], "n", group_rows)
    assert {r.id: r.n for r in got.collect()} == numbers
    assert set(got.columns) == {"id", "k", "t", "v", "n"}
    got = ordered.running_sum(frame, ["k"], ["t", "id"], F.col("t"), "s", group_rows)
    assert {r.id: r.s for r in got.collect()} == sums
    got = ordered.previous(frame, ["k"], ["t", "id"], ["v", "id"], "p", group_rows).collect()
    assert {r.id: (tuple(r.p) if r.p else None) for r in got} == before


@pytest.mark.parametrize("group_rows", [200, 10**6])
def test_without_keys(frame, group_rows):
    got = ordered.row_number(frame, [], ["t", "id"], "n", group_rows).collect()
    order = sorted((r[2], r[0]) for r in rows())
    assert {r.id: r.n for r in got} == {i: n for n, (_, i) in enumerate(order, 1)}


@pytest.mark.parametrize("group_rows", [0, 200])
def test_empty(frame, group_rows):
    none = frame.filter("id < 0")
    assert ordered.row_number(none, ["k"], ["t", "id"], "n", group_rows).count() == 0


def test_no_run_is_a_whole_hot_group(frame):
    runs = ordered._runs(frame, ["k"], ["t", "id"], 15)
    sizes = runs.filter("k = 'hot'").groupBy(ordered.RUN).count().collect()
    assert len(sizes) > 3
    assert max(r["count"] for r in sizes) < 500 < frame.filter("k = 'hot'").count()
    same_time = runs.filter("k = 'hot' and t = 500").select(ordered.RUN).distinct().count()
    assert same_time > 1


def test_only_large_groups_are_cut(frame):
    cut = []

    def in_runs(runs):
        cut.extend(runs.select("k").distinct().collect())
        return runs.drop(ordered.RUN)

    got = ordered._by_size(frame, ["k"], ["t", "id"], 600, lambda rows: rows, in_runs)
    assert [r.k for r in cut] == ["hot"] and got.count() == 3000
    assert ordered._sizes(frame, ["k"], 10).large_rows == 3000


@pytest.mark.parametrize("group_rows", [2, 1000])
def test_null_weights_count_as_nothing(spark, group_rows):
    weights = [None, None, 1, None, 5, None, None, 2, None]
    rows = [(i // 5, i, w) for i, w in enumerate(weights)]
    frame = spark.createDataFrame(rows, "k bigint, o bigint, w bigint")
    got = ordered.running_sum(frame, ["k"], ["o"], F.col("w"), "s", group_rows)
    want = {0: None, 1: None, 2: 1, 3: 1, 4: 6, 5: None, 6: None, 7: 2, 8: 2}
    assert {r.o: r.s for r in got.collect()} == want


def test_runs_of_many_small_groups_are_no_more_than_partitions(spark):
    few = spark.range(4000).selectExpr("id % 100 k", "id o")
    runs = []

    def in_runs(cut):
        runs.append(cut.select(ordered.RUN).distinct().count())
        return cut.drop(ordered.RUN)

    got = ordered._by_size(few, ["k"], ["o"], 10, lambda rows: rows, in_runs)
    assert got.count() == 4000
    assert 1 < runs[0] <= int(spark.conf.get("spark.sql.shuffle.partitions"))
