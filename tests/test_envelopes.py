import json

import pytest
from conftest import at, since
from pyspark.sql import functions as F

from wattlake.operators import envelopes, rollups, windows
from wattlake.schemas import KAFKA_ROW, METRIC_FIELDS
from wattlake.sources import files


@pytest.fixture(scope="module")
def metrics(make):
    rows = [(i, i % 8, i * 7, 1.0 + i % 5) for i in range(120)]
    return windows.tumble(make(rows), "60 seconds", exact=True)


def as_set(frame):
    return {tuple(r) for r in frame.select("window_start", "collector_id", *METRIC_FIELDS).collect()}


def messages(spark, values):
    rows = [(b"collector-1", v, "t", 0, i, at(100 + i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_ROW)


METRIC = {
    "meter_id": "METER-0000", "count": 2, "sum_kwh": 10.0, "avg_kwh": 5.0, "min_kwh": 4.9,
    "max_kwh": 5.1, "avg_voltage": 220.0, "avg_current": 22.7,
    "first_reading": 1704067205000000, "last_reading": 1704067210000000,
}
ENVELOPE = {
    "window_start": 1704067200000000, "window_end": 1704067230000000, "shard_id": 0,
    "collector_id": "collector-1", "total_count": 2, "metrics": [METRIC],
}


def encoded(**changes):
    body = {k: v for k, v in (ENVELOPE | changes).items() if v is not ...}
    return json.dumps(body).encode()


@pytest.mark.parametrize("nest", [envelopes.nest_map, envelopes.nest_array])
@pytest.mark.parametrize("max_metrics", [1, 3, 2000])
def test_nest_then_explode_is_identity(metrics, nest, max_metrics):
    nested = nest(metrics, max_metrics)
    assert as_set(envelopes.explode_metrics(nested)) == as_set(metrics)
    windows_count = envelopes.summarize(metrics).count()
    assert nested.filter("part = 0").count() == windows_count
    assert envelopes.summarize_envelopes(nested).count() == windows_count
    assert nested.agg(F.sum("total_count")).first()[0] == 120
    if max_metrics == 2000:
        assert nested.count() == windows_count


def test_only_windows_over_the_limit_are_split(make):
    """A large window has exact parts; the others stay whole, and all measures are the same."""
    rows = [(i, i, 1, 1.0 + i % 5) for i in range(40)] + [(100 + i, i, 70, 2.0) for i in range(7)]
    table = windows.tumble(make(rows, total=40, shards=1), "60 seconds", exact=True)
    for nest in (envelopes.nest_array, envelopes.nest_map):
        parts, one = nest(table, 8), nest(table)
        sizes = parts.select("window_start", "part", F.size("metrics").alias("n")).collect()
        assert sorted((r.part, r.n) for r in sizes) == [(0, 7), (0, 8), (1, 8), (2, 8), (3, 8), (4, 8)]
        for measure in (envelopes.with_envelope_totals, envelopes.envelope_summary, envelopes.summarize_envelopes):
            got, want = (
                {tuple(r) for r in measure(x).drop("metrics", "whole").collect()} for x in (parts, one)
            )
            assert got == want and len(want) == 2
        assert envelopes.explode_metrics(parts).exceptAll(envelopes.explode_metrics(one)).count() == 0
        assert rollups.dataset_info(parts).first()[0] == 2
        assert tuple(rollups.service_stats(parts).first()) == (2, 47)
        assert sum(r.windows for r in rollups.windows_per_collector(parts).collect()) == 2


def test_flat_table(metrics, spark):
    flat = envelopes.flatten_metrics(envelopes.nest_array(metrics))
    assert len(flat.columns) == 12 and flat.count() == metrics.count()
    none = envelopes.nest_array(metrics.filter("false"))
    assert envelopes.flatten_metrics(none).count() == 0


def test_kafka_wire_format(metrics):
    row = envelopes.to_kafka_rows(envelopes.nest_array(metrics)).first()
    body = json.loads(bytes(row.value))
    assert bytes(row.key).decode() == body["collector_id"]
    assert isinstance(body["window_start"], int) and isinstance(body["metrics"], list)
    assert set(METRIC) == set(body["metrics"][0])


def test_kafka_roundtrip(metrics):
    for nest in (envelopes.nest_array, envelopes.nest_map):
        good, bad = envelopes.parse_array_envelopes(envelopes.to_kafka_rows(nest(metrics)))
        assert as_set(envelopes.explode_metrics(good)) == as_set(metrics)
        assert bad.count() == 0


def test_malformed_messages(spark):
    twice = encoded() + encoded()
    bad_values = [b"\xffA", b"{bad", b"[1]", None, b"null", b'"text"', b"", twice, encoded() + b" x",
                  encoded().replace(b'"', b"'"), b"[" + encoded() + b"]", b"  ",
                  encoded(total_count="many"), encoded(metrics={"a": METRIC})]
    rows = messages(spark, [encoded(), *bad_values, encoded(collector_id="collector-2")])
    good, bad = envelopes.parse_array_envelopes(rows)
    assert {r.offset for r in bad.collect()} == set(range(1, len(bad_values) + 1))
    assert bad.columns == rows.columns
    assert [r.collector_id for r in good.orderBy("offset").collect()] == ["collector-1", "collector-2"]


def test_defaults(spark):
    bare = {"meter_id": "METER-0001"}
    rows = messages(spark, [
        encoded(metrics=...), encoded(total_count=...), encoded(collector_id=...),
        encoded(metrics=[bare, None, {"count": 3}, METRIC | {"meter_id": ""}]),
        encoded(window_end=...), b"{}",
    ])
    good, bad = envelopes.parse_array_envelopes(rows)
    full = envelopes.apply_defaults(good)
    got = {r.offset: r for r in full.collect()}
    assert bad.count() == 0 and len(got) == 6
    assert got[0].metrics == [] and got[1].total_count == 0 and got[2].collector_id == "?"
    assert since(got[4].window_end) == 104 and got[5].total_count == 0
    assert (got[5].collector_id, got[5].metrics) == ("?", [])
    filled = got[3].metrics[0]
    assert (filled["count"], filled.sum_kwh, filled.avg_voltage, filled.min_kwh) == (0, 0.0, 0.0, None)
    exploded = envelopes.explode_metrics(full.filter("offset = 3")).collect()
    assert [r.meter_id for r in exploded] == ["METER-0001"]
    totals = envelopes.with_envelope_totals(full).orderBy("offset").collect()
    assert [r.total_kwh for r in totals] == [0.0, 10.0, 10.0, 10.0, 10.0, 0.0]
    report = rollups.energy_report(envelopes.explode_metrics(full.filter("offset = 3")))
    row = report.first()
    assert (row.total_readings, row.active_meters, row.min_kwh, row.weighted_avg_kwh) == (0, 1, 0, 0)


def test_envelope_summary(spark):
    two = METRIC | {"meter_id": "METER-0001", "sum_kwh": 30.0, "avg_kwh": 3.0, "count": 10}
    rows = messages(spark, [encoded(metrics=[METRIC, two], total_count=12), encoded(metrics=[])])
    good, _ = envelopes.parse_array_envelopes(rows)
    got = envelopes.envelope_summary(good.orderBy("offset")).collect()
    facts = {(r.meters_count, r.total_kwh, r.mean_of_avg_kwh) for r in got}
    assert facts == {(2, 40.0, 4.0), (0, 0.0, 0.0)}


def test_map_form_from_landing_folder(spark, metrics, tmp_path):
    nested = envelopes.nest_map(metrics)
    text = envelopes.to_map_json(nested)
    body = json.loads(text.first().value)
    assert isinstance(body["metrics"], dict) and body["window_start"].endswith("Z")
    text.write.text(str(tmp_path / "landing"))
    (tmp_path / "landing" / "more.txt").write_text("{bad\n\n{}\n[1]\n")
    got = files.read_map_envelopes(spark, str(tmp_path / "landing"))
    assert as_set(envelopes.explode_metrics(got)) == as_set(metrics)
    assert got.count() == nested.count() and got.filter("received_at is null").count() == 0
    rejected = files.rejected_map_envelopes(spark, str(tmp_path / "landing"))
    assert {r.value for r in rejected.collect()} == {"{bad", "", "{}", "[1]"}
    newest = rollups.latest_window(got.select("window_end", "collector_id", "received_at"))
    assert newest.count() == 1


def test_go_style_times_in_map_form(spark):
    body = {"window_start": "2024-01-01T00:00:00.123456789Z", "window_end": "2024-01-01T02:00:30+02:00",
            "shard_id": 1, "collector_id": "c", "total_count": 0, "metrics": {}}
    frame = spark.createDataFrame([(json.dumps(body),)], "value string")
    row = envelopes.parse_map_envelopes(frame)[0].first()
    assert since(row.window_start) == pytest.approx(0.123456) and since(row.window_end) == 30


def test_json_is_decoded_once_per_message(spark, tmp_path):
    messages(spark, [encoded()]).write.parquet(str(tmp_path / "k"))
    rows = spark.read.parquet(str(tmp_path / "k"))
    good, bad = envelopes.parse_array_envelopes(rows)
    texts = spark.createDataFrame([("{}",)], "value string")
    for frame in (
        envelopes.explode_metrics(envelopes.apply_defaults(good)),
        bad,
        envelopes.explode_metrics(envelopes.parse_map_envelopes(texts)[0]),
    ):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert text.count("from_json") == 1
        assert text.count("transform(") <= 2
