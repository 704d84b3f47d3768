"""Streams over several files and micro-batches, against the batch result."""

import random
import time

import pytest
from conftest import at
from pyspark.sql import functions as F

from wattlake.functions.rules import valid_only
from wattlake.operators import envelopes, rollups, stored, windows
from wattlake.operators.envelopes import array_envelopes, with_decoded
from wattlake.sources import files
from wattlake.streaming import ingest, reports, run, stateful

READINGS = (
    "event_id bigint, meter_index bigint, ts timestamp, kwh double, voltage double, "
    "current double, meter_id string, shard_id int, collector_id string"
)


def some_rows(n=600, seed=4):
    """In order of time; half of them from one meter, some invalid."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        meter = 1 if rng.random() < 0.5 else rng.randrange(8)
        kwh = 60.0 if i % 11 == 0 else round(rng.uniform(1, 20), 2)
        rows.append((i, meter, i * 2, kwh))
    return rows


@pytest.fixture(scope="module")
def readings(make):
    return make(some_rows()).select("event_id", "meter_index", "ts", "kwh", "voltage", "current",
                                    "meter_id", "shard_id", "collector_id").persist()


def write_parts(frame, path, cuts):
    """One file per part, in order of event_id."""
    for low, high in zip(cuts, cuts[1:]):
        part = frame.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def source(readings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream") / "in")
    write_parts(readings, path, [0, 130, 131, 280, 450, 600])
    return path


def stream(spark, path):
    return spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(path)


def values(frame, columns=None):
    frame = frame.select(sorted(columns or frame.columns))
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect()
    )


def envelope_table(spark, source, tmp_path, parts=1):
    out = ingest.envelope_stream(stream(spark, source), "60 seconds", "10 seconds", parts)
    run.to_table(out, str(tmp_path / "e"), str(tmp_path / "c")).awaitTermination()
    return spark.read.schema(out.schema).parquet(str(tmp_path / "e"))


@pytest.mark.parametrize("parts", [1, 3])
def test_envelopes_equal_batch(spark, source, readings, tmp_path, parts):
    closed = envelope_table(spark, source, tmp_path, parts)
    batch = windows.tumble(valid_only(readings), "60 seconds")
    rest = run.final_flush(valid_only(readings), closed, "60 seconds")
    assert 0 < rest.count() < batch.count()
    whole = envelopes.explode_metrics(closed).select(batch.columns).unionByName(rest)
    assert values(whole) == values(batch)
    assert (closed.filter("part > 0").count() > 0) == (parts > 1)
    assert closed.filter("part = 0").count() == envelopes.summarize_envelopes(closed).count()
    assert closed.agg(F.sum("total_count")).first()[0] + rest.agg(F.sum("count")).first()[0] == (
        valid_only(readings).count()
    )


def test_metric_stream_equals_batch(spark, source, readings, tmp_path):
    out = ingest.metric_stream(stream(spark, source), "60 seconds", "10 seconds")
    run.to_table(out, str(tmp_path / "m"), str(tmp_path / "c")).awaitTermination()
    closed = spark.read.schema(out.schema).parquet(str(tmp_path / "m"))
    batch = windows.tumble(valid_only(readings), "60 seconds")
    rest = run.final_flush(valid_only(readings), closed, "60 seconds")
    assert values(closed.unionByName(rest)) == values(batch)


def test_final_flush_of_nothing_emitted(readings):
    good = valid_only(readings)
    batch = windows.tumble(good, "60 seconds")
    assert values(run.final_flush(good, batch.filter("false"), "60 seconds")) == values(batch)


def test_report_equals_batch(spark, source, tmp_path):
    table = envelope_table(spark, source, tmp_path)
    again = spark.readStream.schema(table.schema).parquet(str(tmp_path / "e"))
    out = reports.report_stream(again, "5 minutes", "0 seconds")
    run.to_table(out, str(tmp_path / "r"), str(tmp_path / "c2")).awaitTermination()
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "r"))
    batch = rollups.periodic_report(envelopes.explode_metrics(table), "5 minutes")
    closed = batch.join(got, "interval_start", "left_semi")
    assert got.count() >= 2 and batch.count() - got.count() <= 1
    assert values(got) == values(closed, got.columns)


def test_report_counts_empty_envelopes_and_parts(spark, tmp_path):
    metric = ("m1", 2, 10.0, 5.0, 1.0, 9.0, 220.0, 3.0, None, None)
    blank = ("", 7, 70.0, 10.0, 0.1, 99.0, 220.0, 3.0, None, None)
    schema = (
        "window_start timestamp, window_end timestamp, shard_id int, collector_id string, "
        "total_count bigint, metrics array<struct<meter_id string, count bigint, sum_kwh double, "
        "avg_kwh double, min_kwh double, max_kwh double, avg_voltage double, avg_current double, "
        "first_reading timestamp, last_reading timestamp>>, part int"
    )
    rows = [
        (at(0), at(30), 0, "a", 2, [metric], 0),
        (at(0), at(30), 0, "a", 2, [metric], 1),
        (at(0), at(31), 1, "b", 0, [], 0),
        (at(0), at(32), 1, "b", 7, [blank], 0),
        (at(900), at(930), 1, "b", 0, None, None),
    ]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = reports.report_stream(source, "60 seconds", "0 seconds")
    run.to_table(out, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    first = spark.read.schema(out.schema).parquet(str(tmp_path / "r")).orderBy("interval_start").first()
    assert (first.windows, first.total_readings, first.active_meters) == (3, 4, 1)
    assert (first.total_kwh, first.max_kwh) == (20.0, 9.0)


def test_cumulative_tables(spark, source, tmp_path):
    table = envelope_table(spark, source, tmp_path)
    for name, of, want, key in (
        ("k", reports.collector_totals, rollups.collector_stats(envelopes.summarize_envelopes(table)),
         ["collector_id", "windows", "readings"]),
        ("m", reports.meter_totals, rollups.merge_metrics(envelopes.explode_metrics(table)),
         ["meter_id", "count", "sum_kwh", "min_kwh", "max_kwh"]),
    ):
        again = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2)
        totals = of(again.parquet(str(tmp_path / "e")))
        sink = run.BucketTable(spark, str(tmp_path / name), key[:1], buckets=4)
        run.run_available_now(totals, sink, str(tmp_path / f"c{name}"), mode="update")
        assert values(sink.read(totals.schema), key) == values(want, key)


def hybrid(spark, path, out, duration, n, delay):
    """Closed windows and late readings of all that lies in `path`, in tables under `out`."""
    run.use_rocksdb(spark)
    sink = stateful.hybrid_sink(run.table_sink(f"{out}-w"), run.table_sink(f"{out}-l"), duration, exact=True)
    run.run_available_now(stateful.hybrid_stream(stream(spark, path), duration, n, delay), sink, f"{out}-c")
    return [spark.read.parquet(f"{out}-{x}").drop("batch") for x in "wl"]


@pytest.mark.parametrize("duration, n", [("5 minutes", 20), (None, 35), ("1 minute", 1000)])
def test_hybrid_equals_batch(spark, source, readings, tmp_path, duration, n):
    closed, late = hybrid(spark, source, str(tmp_path / "h"), duration, n, "10 seconds")
    batch = windows.tumble_hybrid(valid_only(readings), duration, n, exact=True)
    left = stateful.open_windows(readings, closed, late, duration, n, exact=True)
    assert closed.count() > 0 and left.count() > 0 and late.count() == 0
    assert values(closed.unionByName(left)) == values(batch, left.columns)


def test_anomalies_equal_batch(spark, source, readings, tmp_path):
    run.use_rocksdb(spark)
    out = str(tmp_path / "a")
    run.to_table(stateful.anomaly_stream(stream(spark, source)), out, f"{out}-c").awaitTermination()
    columns = ["event_id", "anomaly_code"]
    assert values(spark.read.parquet(out), columns) == values(windows.with_anomaly(readings), columns)


def test_anomalies_with_a_time_to_live(spark, source, readings, tmp_path):
    """By the clock there is always another batch, so such a stream runs by a period until stopped."""
    run.use_rocksdb(spark)
    sink, out = run.table_sink(str(tmp_path / "a")), str(tmp_path / "a")
    coded = stateful.anomaly_stream(stream(spark, source), ttl="1 hour")
    query = run.to_sink(coded, sink, f"{out}-c", every="1 second")
    try:
        until = time.time() + 90
        while time.time() < until:
            time.sleep(2)
            done = query.lastProgress and query.lastProgress["batchId"] >= 6
            if done:
                break
    finally:
        query.stop()
    columns = ["event_id", "anomaly_code"]
    assert values(spark.read.parquet(out), columns) == values(windows.with_anomaly(readings), columns)


def test_anomalies_tell_null_from_nan(spark, tmp_path):
    run.use_rocksdb(spark)
    rows = [(1, "m", at(1), 1.0, 220.0), (2, "m", at(2), float("nan"), 220.0), (3, "m", at(3), None, 220.0), (4, "m", at(4), 1.0, 220.0)]
    frame = spark.createDataFrame(rows, "event_id bigint, meter_id string, ts timestamp, kwh double, voltage double")
    path = str(tmp_path / "in")
    for number in (1, 2, 3, 4):
        frame.filter(f"event_id = {number}").coalesce(1).write.mode("append").parquet(path)
    live = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)
    for nan in ("pass", "reject"):
        run.to_table(stateful.anomaly_stream(live, nan=nan), f"{path}-{nan}", f"{path}-c{nan}").awaitTermination()
        columns = ["event_id", "anomaly_code"]
        assert values(spark.read.parquet(f"{path}-{nan}"), columns) == values(windows.with_anomaly(frame, nan=nan), columns)


def test_restart_goes_on_where_it_stopped(spark, readings, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "h")
    batch = windows.tumble_hybrid(valid_only(readings), "5 minutes", 20, exact=True)
    for cuts in ([0, 100, 250], [250, 400, 600]):
        write_parts(readings, path, cuts)
        closed, late = hybrid(spark, path, out, "5 minutes", 20, "0 seconds")
        metrics = ingest.metric_stream(stream(spark, path), "60 seconds", "10 seconds")
        run.to_table(metrics, str(tmp_path / "m"), str(tmp_path / "cm")).awaitTermination()
    left = stateful.open_windows(readings, closed, late, "5 minutes", 20, exact=True)
    assert values(closed.unionByName(left)) == values(batch, left.columns)
    closed = spark.read.schema(metrics.schema).parquet(str(tmp_path / "m"))
    rest = run.final_flush(valid_only(readings), closed, "60 seconds")
    want = windows.tumble(valid_only(readings), "60 seconds")
    assert values(closed.unionByName(rest)) == values(want)


def test_parts_give_what_whole_windows_give(spark, source, readings, tmp_path):
    """Totals, summaries, metrics and cumulative tables do not depend on the number of parts."""
    got = {}
    for parts in (1, 3):
        (tmp_path / str(parts)).mkdir()
        table = envelope_table(spark, source, tmp_path / str(parts), parts)
        again = spark.readStream.schema(table.schema).parquet(str(tmp_path / str(parts) / "e"))
        totals = run.BucketTable(spark, str(tmp_path / f"t{parts}"), ["collector_id"], 4)
        run.run_available_now(reports.collector_totals(again), totals, str(tmp_path / f"c{parts}"), mode="update")
        sent = envelopes.array_envelopes(envelopes.with_decoded(envelopes.to_kafka_rows(table))).select(table.columns)
        got[parts] = [
            values(frame)
            for frame in (
                envelopes.with_envelope_totals(table).drop("metrics", "whole", "part"),
                envelopes.envelope_summary(table),
                envelopes.summarize_envelopes(sent),
                envelopes.explode_metrics(envelopes.with_facts(table)),
                envelopes.explode_metrics(envelopes.with_facts(sent)),
                totals.read(reports.collector_totals(table).schema),
            )
        ]
    assert got[1] == got[3] and got[1][3]


def test_bucket_table(spark, tmp_path):
    schema = "k string, v int"
    table = run.BucketTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    assert table.read(spark.createDataFrame([], schema).schema).count() == 0
    want = {}
    for batch_id in range(12):
        rows = {f"k{(batch_id * 5 + i) % 9}": batch_id * 10 + i for i in range(2)}
        if batch_id == 4:
            rows = {None: 1}
        batch = spark.createDataFrame(list(rows.items()), schema)
        for _ in range(2 if batch_id % 3 == 0 else 1):  # repeated batches
            table(batch, batch_id)
        want |= rows
        assert dict(map(tuple, table.read(batch.schema).collect())) == want
    kept = list((tmp_path / "t" / "rows").glob("*/in_bucket=*"))
    assert len(kept) <= 6 and len(list((tmp_path / "t" / "lists").glob("batch=*"))) == 2


def test_a_failing_sink_repeats_no_other(spark, tmp_path):
    seen = {"a": [], "b": []}

    def b(batch, batch_id):
        if batch_id == 1 and 1 not in seen["b"] and "failed" not in seen:
            seen["failed"] = True
            raise RuntimeError("down")
        seen["b"].append(batch_id)

    sink = run.fan_out(lambda batch, n: seen["a"].append(n), b, ledger=str(tmp_path / "ledger"))
    frame = spark.range(3)
    sink(frame, 0)
    with pytest.raises(RuntimeError):
        sink(frame, 1)
    for batch_id in (1, 2, 2):
        sink(frame, batch_id)
    assert seen["a"] == [0, 1, 2] and seen["b"] == [0, 1, 2]


def test_store_keeps_the_last_write(spark, make, tmp_path):
    columns = [c.split()[0] for c in READINGS.split(", ")]
    rows = make([(0, 0, 10.1, 1.0), (1, 0, 10.9, 2.0), (2, 1, 10.5, 3.0), (3, 0, 10.2, 4.0)])
    write_parts(rows.select(columns), str(tmp_path / "in"), [0, 1, 2, 3, 4])
    sink = run.readings_sink(str(tmp_path / "store"))
    run.run_available_now(stream(spark, str(tmp_path / "in")), sink, str(tmp_path / "c"))
    sink(rows.filter("event_id = 3"), 3)
    table = files.read_readings(spark, str(tmp_path / "store"))
    kept = stored.upsert_latest(table, order=["ingest_order"])
    assert table.count() == 5 and {(r.meter_id, r.kwh) for r in kept.collect()} == {
        ("METER-0000", 4.0), ("METER-0001", 3.0)}


def test_late_readings_are_dropped_and_counted(spark, make, tmp_path):
    columns = [c.split()[0] for c in READINGS.split(", ")]
    rows = make([(0, 0, 10, 5.0), (1, 0, 500, 5.0), (2, 0, 1000, 5.0), (3, 0, 20, 5.0), (4, 0, 1010, 5.0)])
    path = str(tmp_path / "in")
    write_parts(rows.select(columns), path, [0, 2, 3, 4, 5])
    out = ingest.metric_stream(stream(spark, path), "60 seconds", "30 seconds")
    listener = run.LateRows()
    spark.streams.addListener(listener)
    try:
        query = run.to_table(out, str(tmp_path / "m"), str(tmp_path / "c"))
        query.awaitTermination()
        for _ in range(50):  # the listener hears of progress a little later
            if listener.dropped.get(str(query.id)):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.dropped[str(query.id)] == 1
    closed = spark.read.schema(out.schema).parquet(str(tmp_path / "m"))
    assert closed.agg(F.sum("count")).first()[0] == 2
    closed, late = hybrid(spark, path, str(tmp_path / "h"), "60 seconds", 10, "30 seconds")
    left = stateful.open_windows(rows, closed, late, "60 seconds", 10)
    assert [r.event_id for r in late.collect()] == [3]
    assert (closed.agg(F.sum("count")).first()[0] or 0) + left.agg(F.sum("count")).first()[0] == 4


def test_dead_letters_and_fan_out(spark, readings, tmp_path):
    table = envelopes.nest_array(windows.tumble(valid_only(readings), "60 seconds"))
    sent = envelopes.to_kafka_rows(table).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    broken = sent.limit(3).withColumn("value", F.expr("substring(value, 1, 20)"))
    (tmp_path / "in").mkdir()
    sent.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    broken.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    good = run.fan_out(run.table_sink(str(tmp_path / "g1")), run.table_sink(str(tmp_path / "g2")))
    sink = run.envelope_sink(good, run.table_sink(str(tmp_path / "bad")))
    source = files.stream_kafka_files(spark, str(tmp_path / "in"), files_per_trigger=1)
    run.run_available_now(source, sink, str(tmp_path / "c"))
    one, two = (spark.read.parquet(str(tmp_path / g)) for g in ("g1", "g2"))
    assert one.count() == two.count() == table.count()
    assert values(envelopes.explode_metrics(one), ["meter_id", "count"]) == values(
        envelopes.explode_metrics(table), ["meter_id", "count"]
    )
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 3


def test_messages_to_report_without_a_sink_between(spark, readings, tmp_path):
    table = windows.tumble(valid_only(readings), "60 seconds")
    nested = envelopes.nest_array(table, max_metrics=2)
    sent = envelopes.to_kafka_rows(nested).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = files.stream_kafka_files(spark, str(tmp_path / "in"))
    out = reports.report_stream(array_envelopes(with_decoded(source)), "5 minutes", "0 seconds")
    run.to_table(out, str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "r"))
    batch = rollups.periodic_report(table, "5 minutes").join(got, "interval_start", "left_semi")
    assert got.count() >= 3 and values(got) == values(batch, got.columns)


def test_landing_folder_stream(spark, readings, tmp_path):
    table = windows.tumble(valid_only(readings), "60 seconds")
    nested = envelopes.nest_map(table)
    envelopes.to_map_json(nested).write.text(str(tmp_path / "in"))
    source = files.stream_map_envelopes(spark, str(tmp_path / "in"))
    run.run_available_now(source, run.table_sink(str(tmp_path / "o")), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == nested.count() and got.filter("received_at is null").count() == 0


def test_json_source_and_periodic_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = '{"meter_id":"METER-0001","timestamp":"2024-01-01T00:00:05Z","kwh":5.0,"voltage":220.0,"current":22.7}'
    (tmp_path / "in" / "a.json").write_text(f"{line}\n{{bad\n")
    source = files.stream_readings(spark, str(tmp_path / "in"))
    query = run.to_sink(source, run.table_sink(str(tmp_path / "o")), str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        (tmp_path / "in" / "b.json").write_text(line + "\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
