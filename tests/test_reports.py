import numpy as np
import pytest
from conftest import at, since

from wattlake.operators import envelopes, profile, rollups, windows

METRIC_DDL = (
    "window_start timestamp, window_end timestamp, shard_id int, collector_id string, "
    "meter_id string, count bigint, sum_kwh double, avg_kwh double, min_kwh double, "
    "max_kwh double, avg_voltage double, avg_current double, first_reading timestamp, "
    "last_reading timestamp"
)


@pytest.fixture(scope="module")
def metrics(spark):
    def row(start, shard, meter, count, total, voltage):
        return (at(start), at(start + 60), shard, f"collector-{shard + 1}", meter, count, total,
                total / count, total / count / 2, total / count * 2, voltage, 10.0 * count,
                at(start), at(start + 50))

    return spark.createDataFrame(
        [
            row(0, 0, "m1", 1, 10.0, 210.0),
            row(0, 0, "m2", 9, 18.0, 230.0),
            row(60, 0, "m1", 3, 3.0, 220.0),
            row(60, 1, "m3", 7, 14.0, 200.0),
        ],
        METRIC_DDL,
    )


def test_weighted_report(metrics):
    r = rollups.energy_report(metrics).first()
    assert (r.windows, r.total_readings, r.active_meters, r.total_kwh) == (3, 20, 3, 45.0)
    assert r.weighted_avg_kwh == pytest.approx(45 / 20)
    assert r.weighted_avg_voltage == pytest.approx((210 + 9 * 230 + 3 * 220 + 7 * 200) / 20)
    assert r.weighted_avg_current == pytest.approx((10 + 90 * 9 + 30 * 3 + 70 * 7) / 20)
    assert (r.min_kwh, r.max_kwh) == (0.5, 20.0)
    assert r.readings_per_sec == pytest.approx(20 / 120)
    assert rollups.energy_report(metrics, elapsed=10).first().readings_per_sec == 2.0
    assert rollups.energy_report(metrics, elapsed=0).first().readings_per_sec == 0.0


def test_report_of_nothing_is_zero(metrics):
    r = rollups.energy_report(metrics.filter("false")).first()
    assert set(r) == {0}
    r = rollups.flat_summary(metrics.filter("false")).first()
    assert (r.total_rows, r.collectors, r.meters, r.total_kwh) == (0, 0, 0, 0.0)
    r = rollups.service_stats(envelopes.summarize(metrics.filter("false"))).first()
    assert tuple(r) == (0, 0)
    assert rollups.throughput(metrics.filter("false")).first().readings_per_sec == 0.0
    assert rollups.latest_window(envelopes.summarize(metrics.filter("false")), ["window_end"]).count() == 0
    assert rollups.kpis(metrics.filter("false")).first().total_readings == 0


def test_unweighted_summary(metrics):
    for exact in (False, True):
        r = rollups.flat_summary(metrics, exact).first()
        assert (r.total_rows, r.collectors, r.meters, r.total_kwh) == (4, 2, 3, 45.0)
        assert r.mean_of_avg_kwh == pytest.approx((10 + 2 + 1 + 2) / 4)
        assert r.mean_of_avg_voltage == pytest.approx(215.0)


def test_by_collector(metrics):
    got = [tuple(r) for r in rollups.by_collector(metrics).collect()]
    assert got == [("collector-1", 31.0, 13, 2), ("collector-2", 14.0, 7, 1)]


def test_kpis_separate_retained_from_all(metrics):
    r = rollups.kpis(metrics, n=2).first()
    assert (r.total_readings, r.active_meters, r.windows_received, r.retained_points) == (20, 3, 3, 2)
    assert (r.retained_kwh, r.total_kwh) == (17.0, 45.0)
    assert since(r.last_update) == 120
    assert r.readings_per_sec == 0.0  # both retained windows end at the same time
    assert rollups.kpis(metrics, n=2, as_of=at(130)).first().readings_per_sec == pytest.approx(2.0)


def test_dashboard_tables(metrics):
    seen = envelopes.summarize(metrics)
    stats = {r.collector_id: (r.windows, r.readings, r.total_kwh) for r in rollups.collector_stats(seen).collect()}
    assert stats == {"collector-1": (2, 13, 31.0), "collector-2": (1, 7, 14.0)}
    table = rollups.meter_table(metrics).collect()
    assert [(r.meter_id, r.total_kwh, r.avg_kwh) for r in table] == [
        ("m2", 18.0, 2.0), ("m3", 14.0, 2.0), ("m1", 13.0, 3.25)]
    assert [r.meter_id for r in rollups.top_meters(metrics, 2).collect()] == ["m2", "m3"]
    rate = {r.collector_id: (r.readings, r.windows) for r in rollups.reading_rate(seen, 2).collect()}
    assert rate == {"collector-1": (3, 1), "collector-2": (7, 1)}
    points = rollups.energy_series(seen).collect()
    assert [(p.collector, since(p.time)) for p in points] == [
        ("collector-1", 60), ("collector-1", 120), ("collector-2", 120)]


def test_intake_statistics(spark):
    rows = [(at(10), "a", 0, 5, at(100)), (at(40), "b", 1, 6, at(90)), (at(41), "", 2, 1, at(80)),
            (at(39), None, 3, 1, at(70)), (at(35), "a", 4, 2, at(60))]
    seen = spark.createDataFrame(
        rows, "window_end timestamp, collector_id string, shard_id int, total_count bigint, received_at timestamp"
    )
    assert tuple(rollups.service_stats(seen).first()) == (5, 15)
    assert {tuple(r) for r in rollups.windows_per_collector(seen).collect()} == {("a", 2), ("b", 1)}
    assert rollups.latest_window(seen).first().shard_id == 0
    assert rollups.dataset_info(seen).first()[0] == 5
    live = rollups.active_collectors(seen.filter("collector_id in ('a', 'b')"), as_of=at(45.5))
    assert {(r.collector_id, r.shard_id) for r in live.collect()} == {("b", 1)}
    live = rollups.active_collectors(seen.filter("collector_id in ('a', 'b')"))
    assert {(r.collector_id, r.shard_id) for r in live.collect()} == {("a", 4), ("b", 1)}


def test_validation_counts(make):
    rows = make([(0, 0, 0, 5.0), (1, 0, 1, 99.0), (2, 0, 2, 5.0, 100.0), (3, 4, 3, None, 220.0, 1.0)])
    got = {r.collector_id: r for r in rollups.validation_counts(rows).collect()}
    one, two = got["collector-1"], got["collector-2"]
    assert (one.collected, one.valid, one.invalid, one.code_1, one.code_2) == (3, 1, 2, 1, 1)
    assert (two.collected, two.valid, two.invalid, two.no_input) == (1, 0, 1, 1)


def test_throughput(metrics):
    r = rollups.throughput(metrics).first()
    assert (r.total_readings, r.elapsed_seconds, r.windows) == (20, 110.0, 3)
    assert r.us_per_reading == pytest.approx(5.5e6)


def test_periodic_report_starts_anew(metrics):
    got = rollups.periodic_report(metrics, "60 seconds").orderBy("interval_start").collect()
    assert [(r.windows, r.total_readings, r.active_meters, r.total_kwh) for r in got] == [
        (1, 10, 2, 28.0), (2, 10, 2, 17.0)]


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("group_rows", [100, 10**6])
@pytest.mark.parametrize("exact", [False, True])
def test_distribution(spark, keys, group_rows, exact):
    rng = np.random.default_rng(3)
    data = [("hot" if i % 3 else "cold", round(float(x), 2)) for i, x in enumerate(rng.normal(20, 5, 900))]
    frame = spark.createDataFrame([*data, ("hot", None), (None, 7.0)], "k string, x double")
    got = profile.distribution(frame, keys, "x", exact, group_rows=group_rows).collect()
    groups = {None: [7.0]} if keys else {}
    for k, x in data if keys else [("all", x) for _, x in data] + [("all", 7.0)]:
        groups.setdefault(k, []).append(x)
    assert len(got) == len(groups)
    for r in got:
        x = np.array(groups[r.k if keys else "all"])
        assert (r.n, r["min"], r["max"]) == (len(x), x.min(), x.max())
        want = [x.mean(), np.std(x), *np.percentile(x, [50, 95, 99])]
        assert [r["mean"], r["std"], r.median, r.p95, r.p99] == pytest.approx(want, abs=1e-9)


def test_approximate_distribution(spark):
    frame = spark.createDataFrame([("a", float(i)) for i in range(1001)], "k string, x double")
    r = profile.distribution(frame, ["k"], "x", approximate=True).first()
    assert (r.n, r["mean"], r.median) == (1001, 500.0, 500.0) and abs(r.p95 - 950) <= 1


def test_histogram(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,), (float("nan"),)], "x double")
    got = {r.bin: r for r in profile.histogram(frame, "x", 5).collect()}
    assert {b: r["count"] for b, r in got.items()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert (got[0].lower, got[4].upper) == (0.0, 10.0)
    one = profile.histogram(frame.filter("x = 3"), "x", 5).collect()
    assert [(r.bin, r["count"]) for r in one] == [(0, 1)]
    assert profile.histogram(frame.filter("false"), "x").count() == 0


def test_compare_runs(spark):
    rows = [("Go", 10, 100.0, 2.0, 1.0), ("Go", 10, 200.0, 4.0, 1.0), ("Python", 10, 50.0, 6.0, 4.0),
            ("Go", 50, 80.0, 1.0, 1.0), ("Python", 50, 40.0, 1.0, 1.0), ("Go", 100, 1.0, 1.0, 1.0),
            ("Rust", 10, 9.0, 9.0, 9.0)]
    runs = spark.createDataFrame(
        rows, "language string, meters bigint, readings_per_sec double, avg_us_per_read double, peak_mem_mb double"
    )
    got = profile.compare_runs(runs, "Go", "Python")
    first, second = got.collect()
    assert (first.meters, first.runs_a, first.runs_b) == (10, 2, 1)
    assert (first.readings_per_sec_mean_a, first.readings_per_sec_std_a) == (150.0, 50.0)
    assert (first.readings_per_sec_ratio, second.readings_per_sec_ratio) == (3.0, 2.0)
    limits = profile.comparison_range(got).first()
    assert (limits.min_readings_per_sec_ratio, limits.max_readings_per_sec_ratio) == (2.0, 3.0)
    assert (limits.min_avg_us_per_read_mean_a, limits.max_avg_us_per_read_mean_a) == (1.0, 3.0)


def test_summaries_agree(make):
    rows = make([(i, i % 5, i * 9, 2.0) for i in range(60)])
    table = windows.tumble(rows, "60 seconds")
    flat = {tuple(r) for r in envelopes.summarize(table).collect()}
    nested = envelopes.summarize_envelopes(envelopes.nest_map(table, 2))
    assert {tuple(r) for r in nested.select(envelopes.summarize(table).columns).collect()} == flat


def test_exact_deviation_of_more_than_two_decimals(spark):
    rows = [("same", 1.006)] * 50 + [("small", 0.001), ("small", 0.004), ("fine", 7.123456), ("fine", 1.000001)]
    frame = spark.createDataFrame(rows, "k string, v double")
    for options in ({}, {"approximate": True}):
        got = {r.k: r.std for r in profile.distribution(frame, ["k"], "v", exact=True, **options).collect()}
        assert got["same"] == pytest.approx(0, abs=1e-7)
        assert got["small"] == pytest.approx(0.0015, abs=1e-12) and got["fine"] == pytest.approx(3.0617275, abs=1e-12)
    runs = spark.createDataFrame([(x, 1, 1.006) for x in ("a", "b")] + [("a", 1, 1.002)], "language string, meters int, m double")
    row = profile.compare_runs(runs, "a", "b", ["m"], exact=True).first()
    assert row.m_std_a == pytest.approx(0.002, abs=1e-9) and row.m_std_b == pytest.approx(0, abs=1e-7)
