import datetime as dt
import json

import pytest
from conftest import at, since
from pyspark.sql import functions as F

from wattlake.operators import stored, windows
from wattlake.sources import files, kafka


@pytest.fixture(scope="module")
def laid_out(make, tmp_path_factory):
    """Ten days of readings, nine tenths of them on one day."""
    rows = [(i, i % 8, i, 1.0) for i in range(900)]
    rows += [(900 + i, i % 8, 86400 * (i % 10) + i, 1.0) for i in range(100)]
    path = str(tmp_path_factory.mktemp("store") / "readings")
    files.write_readings(make(rows), path)
    return path


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_range_read_reaches_the_scan(spark, laid_out):
    table = files.read_readings(spark, laid_out)
    one = stored.readings_for_meter(table, "METER-0003", "2024-01-01T00:01:40.9", "2024-01-01T00:05:00.9")
    assert {since(r.ts) for r in one.collect()} == {s for s in range(100, 300) if s % 8 == 3}
    text = plan(one)
    assert "EqualTo(meter_id,METER-0003)" in text
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "date#" in text.split("PartitionFilters:")[1].split("]")[0]


def test_range_read_of_all_meters(spark, laid_out):
    table = files.read_readings(spark, laid_out)
    some = stored.readings_between(table, at(86400), at(3 * 86400 + 3))
    assert sorted(since(r.ts) for r in some.collect()) == sorted(
        86400 * (i % 10) + i for i in range(100) if i % 10 in (1, 2)
    )
    text = plan(some)
    assert "GreaterThan(ts," in text and "PartitionFilters: [isnotnull(date" in text


def test_bounds(make):
    rows = make([(0, 0, 10.0, 1.0), (1, 0, 10.5, 1.0), (2, 0, 20.0, 1.0), (3, 0, 20.7, 1.0)])
    ids = lambda frame: {r.event_id for r in frame.collect()}
    assert ids(stored.readings_for_meter(rows, "METER-0000", at(10.4), at(20.9))) == {0, 1}
    assert ids(stored.readings_between(rows, at(10), at(20.7))) == {1, 2}
    assert ids(stored.readings_between(rows, at(10) - dt.timedelta(microseconds=1), at(20))) == {0, 1}


def test_upsert_keeps_the_last_write(make):
    rows = make([(0, 0, 1.1, 1.0), (1, 0, 1.9, 2.0), (2, 0, 2.0, 3.0), (3, 1, 1.2, 4.0), (4, 0, 1.5, 5.0)])
    kept = stored.upsert_latest(rows)
    assert kept.columns == rows.columns
    assert {(r.event_id, r.kwh) for r in kept.collect()} == {(4, 5.0), (2, 3.0), (3, 4.0)}


def test_json_readings(spark, tmp_path):
    good = {"meter_id": "METER-0001", "timestamp": "2024-01-01T00:00:05.123456Z", "kwh": 5.0, "voltage": 220.0, "current": 22.7}
    lines = [json.dumps(good), "{bad", "[1", json.dumps(good | {"kwh": "much"}), json.dumps(good | {"meter_id": "METER-0002"})]
    (tmp_path / "r.json").write_text("\n".join(lines))
    got = files.read_readings(spark, str(tmp_path), "json")
    assert got.columns == ["meter_id", "ts", "kwh", "voltage", "current"]
    assert sorted(r.meter_id for r in got.collect()) == ["METER-0001", "METER-0002"]
    assert got.select("meter_id").distinct().count() == 2
    assert got.count() == 2 and since(got.first().ts) == pytest.approx(5.123456)


def test_metrics_table(spark, make, tmp_path):
    table = windows.tumble(make([(i, i, i, 1.0) for i in range(8)]), "60 seconds")
    path = str(tmp_path / "metrics")
    files.write_metrics(table, path)
    files.write_metrics(table, path)
    back = files.read_metrics(spark, path)
    assert back.count() == 16 and len(back.columns) == 12
    arrow = back.toArrow()
    assert arrow.num_rows == 16 and str(arrow.schema.field("window_end").type).startswith("timestamp[us")


def test_kafka_calls_need_the_connector(spark, make):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_kafka(spark, "localhost:9092")


def test_runs(spark, tmp_path):
    line = {"language": "Go", "meters": 10, "iterations": 20, "total_readings": 200, "duration_ms": 1.5,
            "readings_per_sec": 133.0, "avg_us_per_read": 7.5, "peak_mem_mb": 1.0, "avg_cpu_percent": 0,
            "window_flushes": 1}
    (tmp_path / "runs.json").write_text(json.dumps(line) + "\n")
    row = files.read_runs(spark, str(tmp_path)).first()
    assert row.asDict() == line


def test_store_keeps_the_order_of_writing(spark, make, tmp_path):
    """Later writes win, and later rows of one write; the default orders work on the store."""
    path = str(tmp_path / "store")
    first = make([(1, 0, 10, 1.0), (2, 0, 10, 2.0), (3, 0, 20, 2.1)]).orderBy("event_id").coalesce(1)
    files.write_readings(first, path)
    files.write_readings(make([(4, 0, 20, 9.0)]), path)
    table = files.read_readings(spark, path)
    kept = stored.upsert_latest(table)
    assert sorted(r.kwh for r in kept.collect()) == [2.0, 9.0]
    codes = windows.with_anomaly(kept).orderBy("ts").collect()
    assert [r.anomaly_code for r in codes] == [-1, 5]
    with pytest.raises(ValueError, match="order"):
        stored.upsert_latest(table.drop("ingest_order"))


def test_json_lines_hold_one_object(spark, tmp_path):
    line = '{"meter_id":"METER-0001","timestamp":"2024-01-01T00:00:00Z","kwh":1.0,"voltage":220.0,"current":4.5}'
    bad = [line + line, line + " x", line.replace('"', "'"), f"[{line}]", ""]
    (tmp_path / "in.json").write_text("\n".join([line, *bad]))
    assert files.read_readings(spark, str(tmp_path / "in.json"), "json").count() == 1


def test_merged_store_has_one_reading_for_each_second(spark, make, tmp_path):
    path, columns = str(tmp_path / "store"), ["meter_id", "ts", "kwh"]
    first = make([(0, 0, 10.1, 1.0), (1, 0, 90_000, 2.0), (2, 1, 10.5, 3.0)])
    files.merge_readings(first, path, F.lit(1))
    files.merge_readings(make([(3, 0, 10.9, 9.0), (4, 1, 11.0, 4.0)]), path, F.lit(2))
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("date=2024-01-02/*.parquet")}
    again = make([(5, 0, 10.0, 7.0)])
    for _ in range(2):  # a repeated merge changes nothing
        files.merge_readings(again, path, F.lit(3))
    files.merge_readings(make([(6, 0, 10.0, 8.0)]), path, F.lit(1))  # older than what is there
    table = files.read_readings(spark, path)
    got = sorted((r.meter_id, r.kwh) for r in table.select(columns).collect())
    assert got == [("METER-0000", 2.0), ("METER-0000", 7.0), ("METER-0001", 3.0), ("METER-0001", 4.0)]
    assert untouched and untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("date=2024-01-02/*.parquet")}


def test_merge_of_nothing_and_of_readings_without_time(spark, make, tmp_path):
    path = str(tmp_path / "store")
    rows = make([(0, 0, 10, 1.0), (1, 1, 10, 2.0)])
    lost = rows.withColumn("ts", F.lit(None).cast("timestamp"))
    files.merge_readings(lost, path, F.lit(1))
    files.merge_readings(lost.filter("meter_index = 1").withColumn("kwh", F.lit(5.0)), path, F.lit(2))
    files.merge_readings(rows.filter("false"), path, F.lit(3))
    got = files.read_readings(spark, path).select("meter_id", "kwh").collect()
    assert sorted(map(tuple, got)) == [("METER-0000", 1.0), ("METER-0001", 5.0)]
