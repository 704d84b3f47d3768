"""Windows against a plain re-enactment of the collector loop, and invariants."""

import random

import pytest
from conftest import since
from pyspark.sql import functions as F

from wattlake.operators import envelopes, profile, rollups, windows
from wattlake.schemas import SOURCE_KEYS, window_keys

PERIOD = 60


def random_rows(seed, n=400, meters=6):
    """Half of the rows belong to one meter, so one source has most of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        meter = 1 if rng.random() < 0.5 else rng.randrange(meters)
        rows.append((i, meter, rng.randrange(900), round(rng.uniform(0.5, 20), 2)))
    return rows


def reenact(rows, period, n, shards=2, per_shard=4):
    """(shard, period start, sequence) -> {meter: kwh list}, closing by tick or count."""
    closed = {}
    for shard in range(shards):
        mine = sorted((r for r in rows if r[1] // per_shard == shard), key=lambda r: (r[2], r[0]))
        open_, bucket, seq = [], None, 0
        for row in mine:
            start = row[2] // period * period if period else 0
            if start != bucket:
                if open_:
                    closed[shard, bucket, seq] = open_
                open_, bucket, seq = [], start, 0
            open_.append(row)
            if n and len(open_) == n:
                closed[shard, bucket, seq] = open_
                open_, seq = [], seq + 1
        if open_:
            closed[shard, bucket, seq] = open_
    return closed


def by_window(metrics, period):
    """The same shape from a metric table."""
    got = {}
    for r in metrics.collect():
        start = since(r.first_reading) // period * period if period else 0
        window = got.setdefault((r.shard_id, start, r.window_seq), {})
        window[r.meter_id] = r
    return got


@pytest.mark.parametrize("period, n", [(PERIOD, 7), (PERIOD, 1), (None, 25), (PERIOD, 0), (None, 0)])
@pytest.mark.parametrize("group_rows", [60, 10**6])
def test_hybrid(make, period, n, group_rows):
    rows = random_rows(3)
    duration = f"{period} seconds" if period else None
    table = windows.tumble_hybrid(make(rows), duration, n, group_rows=group_rows)
    want, got = reenact(rows, period, n), by_window(table, period)
    assert set(got) == set(want)
    for key, readings in want.items():
        meters = {}
        for row in readings:
            meters.setdefault(f"METER-{row[1]:04d}", []).append(row)
        assert set(got[key]) == set(meters)
        for meter, own in meters.items():
            r, kwh = got[key][meter], [x[3] for x in own]
            assert r["count"] == len(own)
            assert r.sum_kwh == pytest.approx(sum(kwh))
            assert r.avg_kwh == pytest.approx(sum(kwh) / len(kwh))
            assert (r.min_kwh, r.max_kwh) == (min(kwh), max(kwh))
            assert (since(r.first_reading), since(r.last_reading)) == (own[0][2], own[-1][2])
            if period and (n == 0 or len(readings) < n):
                assert since(r.window_end) == key[1] + period
            else:
                assert since(r.window_end) == readings[-1][2]


def test_bounds_of_counted_windows(make):
    rows = make([(i, 0, i * 10, 1.0) for i in range(8)])
    table = windows.tumble_hybrid(rows, "60 seconds", 4)
    spans = sorted((since(r.window_start), since(r.window_end), r["count"]) for r in table.collect())
    assert spans == [(0, 30, 4), (40, 60, 2), (60, 120, 2)]
    linked = windows.contiguous_bounds(envelopes.summarize(table))
    spans = sorted((since(r.window_start), since(r.window_end)) for r in linked.collect())
    assert spans == [(0, 30), (30, 60), (60, 120)]


@pytest.mark.parametrize("group_rows", [3, 10**6])
def test_contiguous_bounds_skip_empty_periods(make, group_rows):
    rows = make([(i, m, s, 1.0) for i, (m, s) in enumerate([(0, 5), (0, 130), (0, 500), (4, 70)])])
    table = envelopes.summarize(windows.tumble(rows, "60 seconds"))
    linked = windows.contiguous_bounds(table, group_rows).collect()
    spans = sorted((r.shard_id, since(r.window_start), since(r.window_end)) for r in linked)
    assert spans == [(0, 0, 60), (0, 60, 180), (0, 180, 540), (1, 60, 120)]


def test_wrong_parameters(make):
    rows = make([(0, 0, 0, 1.0)])
    for call in (
        lambda: windows.tumble_count(rows, 0),
        lambda: windows.tumble_hybrid(rows, None, -1),
        lambda: windows.slide(rows, "1 minute", "2 minutes"),
        lambda: windows.seconds("500 milliseconds"),
        lambda: windows.seconds("0 seconds"),
    ):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("exact", [False, True])
def test_merging_windows_gives_the_whole(make, seed, exact):
    rows = make(random_rows(seed))
    whole = {r.meter_id: r for r in windows.aggregate_meters(rows, ["meter_id"], exact).collect()}
    for table in (
        windows.tumble(rows, "45 seconds", exact),
        windows.tumble_count(rows, 13, exact=exact),
        windows.tumble_hybrid(rows, "100 seconds", 9, exact=exact),
    ):
        assert table.agg(F.sum("count")).first()[0] == 400
        for r in rollups.merge_metrics(table, exact=exact).collect():
            one = whole[r.meter_id]
            assert (r["count"], r.min_kwh, r.max_kwh) == (one["count"], one.min_kwh, one.max_kwh)
            assert r.sum_kwh == pytest.approx(one.sum_kwh)
            assert r.sum_voltage / r["count"] == pytest.approx(one.avg_voltage)
            assert r.sum_current / r["count"] == pytest.approx(one.avg_current, abs=0.01)


def test_counted_windows_hold_at_most_n(make):
    table = windows.tumble_hybrid(make(random_rows(5)), "200 seconds", 9)
    sizes = table.groupBy(*window_keys(table)).agg(F.sum("count").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 9


@pytest.mark.parametrize("length, hop", [(300, 30), (100, 40), (60, 60), (90, 7)])
@pytest.mark.parametrize("exact", [False, True])
def test_slide(make, length, hop, exact):
    rows = random_rows(7, n=150)
    table = windows.slide(make(rows), f"{length} seconds", f"{hop} seconds", exact)
    origin = 1704067200
    want = {}
    for _, meter, second, kwh in rows:
        start = (origin + second) // hop * hop
        while start + length > origin + second:
            want.setdefault(start - origin, []).append((meter, kwh))
            start -= hop
    got = {since(r.window_start): r for r in table.collect()}
    assert set(got) == set(want)
    for start, inside in want.items():
        r, kwh = got[start], [k for _, k in inside]
        assert since(r.window_end) == start + length
        assert (r["count"], r.active_meters) == (len(inside), len({m for m, _ in inside}))
        assert r.sum_kwh == pytest.approx(sum(kwh))
        assert r.avg_kwh == pytest.approx(sum(kwh) / len(kwh))
        assert (r.min_kwh, r.max_kwh) == (min(kwh), max(kwh))


@pytest.mark.parametrize("group_rows", [40, 10**6])
def test_anomaly_of_a_hot_meter(make, group_rows):
    rows = random_rows(9)
    coded = windows.with_anomaly(make(rows), group_rows=group_rows)
    last, want = {}, {}
    for i, meter, _, kwh in sorted(rows, key=lambda r: (r[2], r[0])):
        before = last.get(meter)
        want[i] = -1 if before is None else 5 if abs((kwh - before) / before) > 0.5 else 0
        last[meter] = kwh
    assert {r.event_id: r.anomaly_code for r in coded.collect()} == want


def test_latest_n(make):
    rows = make([(i, i % 8, i * 60, 1.0) for i in range(20)])
    table = envelopes.summarize(windows.tumble(rows, "60 seconds"))
    assert [since(r.window_end) for r in windows.latest_n(table, 3).collect()] == [1200, 1140, 1080]
    assert windows.latest_n(table).count() == 20


def test_exact_sums_do_not_depend_on_partitions(make):
    rows = make([(i, 0, 0, 0.01 * (i % 97)) for i in range(3000)])
    sums = {
        windows.aggregate_meters(rows.repartition(n), SOURCE_KEYS, exact=True).first().sum_kwh
        for n in (1, 3, 7)
    }
    assert len(sums) == 1


def test_exact_sums_lose_no_decimals(spark):
    frame = spark.range(1000).selectExpr("0.004D AS kwh")
    assert frame.agg(windows.total("kwh", exact=True)).first()[0] == 4.0


def test_sliding_sums_of_small_values(make):
    readings = make([(i, i % 3, i % 40, 0.004) for i in range(1000)])
    got = windows.slide(readings, "60 seconds", "60 seconds", exact=True).collect()
    assert [(r["count"], r.sum_kwh) for r in got] == [(1000, 4.0)]


@pytest.mark.parametrize("values", [[1.0, float("nan")], [1.0, float("inf")], [float("inf"), float("-inf"), 2.0], [1.5, 2.25, None]])
def test_exact_sums_have_nan_and_infinity(spark, values):
    rows = spark.createDataFrame([(1, x) for x in values], "k int, v double").repartition(3)
    exact, plain = (rows.groupBy("k").agg(windows.total("v", x).alias("s")).first().s for x in (True, False))
    assert exact == pytest.approx(plain, nan_ok=True)
    one, two = (profile.distribution(rows, ["k"], "v", exact=x).first().asDict() for x in (True, False))
    assert {k: one[k] for k in ("mean", "std")} == {k: pytest.approx(two[k], nan_ok=True) for k in ("mean", "std")}
