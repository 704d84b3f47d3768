"""Registered queries: every operator over the driver's tables.

Each takes (spark, sf_dir). Times come out as UTC wall-clock time without a zone, like
those of the input. `plans.oracle` has the SQL for the same keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions import columns as C
from wattlake.functions import rules
from wattlake.operators import envelopes, profile, rollups, stored, windows
from wattlake.plans import streamed
from wattlake.schemas import READING, WINDOW_KEYS
from wattlake.session import new_path, written
from wattlake.sources import adapters, files

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that suit 30 days of events; `plans.oracle` uses the same.
DAY = "1 day"
HYBRID = ("7 days", 100)
COUNT_WINDOW = 100
SLIDE = ("5 minutes", "30 seconds")
LATEST = 50
SPLIT = 5
SPLIT_ROWS = 40
TTL = "2 days"
METER = "METER-0007"
RANGE = (dt.datetime(2024, 1, 10, 6, 30, 15, 500000), dt.datetime(2024, 1, 20, 18, 45, 30, 250000))
SLICE = (-3, 40)
TOP = 10
REPORT = "7 days"


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.readings(spark, sf)


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return rules.valid_only(readings(spark, sf))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(valid(spark, sf), DAY, exact=True)


def stored_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metric table written down, for what reads it more than once."""
    return written(metrics(spark, sf), "metrics")


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    return envelopes.summarize(metrics(spark, sf), exact=True)


def _hybrid(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble_hybrid(valid(spark, sf), *HYBRID, exact=True)


def _arrived(spark: SparkSession, sf: str) -> DataFrame:
    """Window summaries with a time of arrival that grows with the end and the shard."""
    late = F.make_interval(secs=F.col("shard_id"))
    return summaries(spark, sf).withColumn("received_at", F.col("window_end") + late)


def _kafka_shaped(rows: DataFrame) -> DataFrame:
    return rows.select(
        "key",
        "value",
        F.lit("energy-aggregated").alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("value").alias("offset"),
        F.lit("2024-02-01 00:00:00 UTC").cast("timestamp").alias("timestamp"),
    )


# --- sources and sinks --------------------------------------------------------------


def scan_readings(spark, sf):
    return readings(spark, sf).select("event_id", *READING.fieldNames())


def readings_roundtrip(spark, sf):
    path = new_path(spark, "readings")
    files.write_readings(readings(spark, sf), path)
    return files.read_readings(spark, path).select(READING.fieldNames())


def json_readings(spark, sf):
    """Through JSON lines in files and back, with every thirteenth line cut short."""
    path = new_path(spark, "json")
    columns = ["meter_id", F.col("ts").alias("timestamp"), "kwh", "voltage", "current"]
    line = F.to_json(F.struct(*columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    rows = readings(spark, sf).select("event_id", line.alias("line"))
    cut = F.expr("if(event_id % 13 = 0, substring(line, 1, 40), line)")
    rows.select(cut.alias("value")).write.text(path)
    return files.read_readings(spark, path, "json")


def upsert_latest(spark, sf):
    kept = stored.upsert_latest(readings(spark, sf), grain="hour")
    return kept.select("event_id", *READING.fieldNames())


def stored_anomalies(spark, sf):
    """Through the store: two writes of the same seconds, the last of each, and its rule."""
    path = new_path(spark, "store")
    first = readings(spark, sf).orderBy("event_id")
    second = first.filter("event_id % 10 = 0").withColumn("kwh", F.col("kwh") + 1)
    files.write_readings(first, path)
    files.write_readings(second, path)
    kept = stored.upsert_latest(files.read_readings(spark, path))
    return windows.with_anomaly(kept).select("meter_id", "ts", "kwh", "anomaly_code")


def _merged_store(spark, sf) -> DataFrame:
    """A store after three merges that overlap: parts of the readings, and new values for some."""
    path = new_path(spark, "store")
    table = readings(spark, sf)
    files.merge_readings(table.filter("event_id % 3 <> 0"), path, F.lit(1))
    files.merge_readings(table.filter("event_id % 10 = 0").withColumn("kwh", F.col("kwh") + 1), path, F.lit(3))
    files.merge_readings(table.filter("event_id % 3 = 0 or event_id % 7 = 0"), path, F.lit(2))
    return files.read_readings(spark, path)


def store_meter_range(spark, sf):
    """The readings of one meter from a merged store, without another upsert."""
    return stored.readings_for_meter(_merged_store(spark, sf), METER, *RANGE).select(READING.fieldNames())


def store_time_range(spark, sf):
    """The readings of all meters from a merged store."""
    return stored.readings_between(_merged_store(spark, sf), *RANGE).select(READING.fieldNames())


def meter_range_scan(spark, sf):
    found = stored.readings_for_meter(readings(spark, sf), METER, *RANGE)
    return found.select("event_id", *READING.fieldNames())


def time_range_scan(spark, sf):
    found = stored.readings_between(readings(spark, sf), *RANGE)
    return found.select("event_id", *READING.fieldNames())


def kafka_rows(spark, sf):
    """Through the JSON of the array form and back, to flat rows."""
    sent = envelopes.to_kafka_rows(envelopes.nest_array(stored_metrics(spark, sf)))
    good, _ = envelopes.parse_array_envelopes(_kafka_shaped(sent))
    named = envelopes.apply_defaults(good.withColumn("message_key", F.col("collector_id")))
    rows = envelopes.explode_metrics(named)
    return rows.select("message_key", "total_count", *_METRIC_TABLE)


def map_envelopes(spark, sf):
    """Through the JSON of the map form and back, to flat rows."""
    sent = envelopes.to_map_json(envelopes.nest_map(stored_metrics(spark, sf)))
    good, _ = envelopes.parse_map_envelopes(sent)
    return envelopes.explode_metrics(good).select("total_count", *_METRIC_TABLE)


def default_rows(spark, sf):
    """Array envelopes of which each lacks one field, with what stands for it."""
    nested = envelopes.nest_array(stored_metrics(spark, sf))
    turn = F.pmod(F.unix_date(F.col("window_start").cast("date")) + F.col("shard_id"), F.lit(4))
    lacking = ["collector_id", "total_count", "metrics", "window_end"]
    sparse = nested.withColumns({c: F.when(turn != k, F.col(c)) for k, c in enumerate(lacking)})
    good, _ = envelopes.parse_array_envelopes(_kafka_shaped(envelopes.to_kafka_rows(sparse)))
    meters = F.size("metrics").cast("bigint").alias("num_meters")
    return envelopes.apply_defaults(good).select(*WINDOW_KEYS, "total_count", meters)


def map_dead_letters(spark, sf):
    """Map bodies of the whole table with defects, by outcome."""
    sent = envelopes.to_map_json(envelopes.nest_map(stored_metrics(spark, sf)))
    day = F.expr("unix_date(cast(get_json_object(value, '$.window_start') as date))")
    good, bad = envelopes.parse_map_envelopes(sent.withColumn("value", _defective(day)))
    outcome = good.select(F.lit("parsed").alias("outcome")).unionAll(
        bad.select(F.lit("dead letter"))
    )
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


_METRIC_TABLE = [
    *WINDOW_KEYS,
    "meter_id",
    "count",
    "sum_kwh",
    "avg_kwh",
    "min_kwh",
    "max_kwh",
    "avg_voltage",
    "avg_current",
    "first_reading",
    "last_reading",
]


def flat_metrics(spark, sf):
    return envelopes.flatten_metrics(envelopes.nest_map(stored_metrics(spark, sf)))


def metrics_roundtrip(spark, sf):
    path = new_path(spark, "metrics")
    files.write_metrics(metrics(spark, sf), path)
    return files.read_metrics(spark, path)


def dataset_info(spark, sf):
    return rollups.dataset_info(summaries(spark, sf))


# --- rules and columns --------------------------------------------------------------


def validate_codes(spark, sf):
    return rules.with_validation(readings(spark, sf)).select(
        "event_id", "meter_id", "error_code", "is_valid"
    )


def power_check(spark, sf):
    return rules.with_power_check(readings(spark, sf)).select(
        "event_id", "calculated_power", "power_diff", "tolerance"
    )


def valid_readings(spark, sf):
    return valid(spark, sf).select("event_id", *READING.fieldNames())


def rejected_readings(spark, sf):
    return rules.rejected(readings(spark, sf)).select(
        "event_id", *READING.fieldNames(), "error_code", "error_text"
    )


def error_messages(spark, sf):
    checked = rules.with_validation(readings(spark, sf))
    return checked.select(
        "event_id", "error_code", rules.error_message(F.col("error_code")).alias("error_message")
    )


def meter_ids(spark, sf):
    name = C.meter_id(F.col("user_id"))
    return (
        adapters.events(spark, sf)
        .groupBy(name.alias("meter_id"))
        .agg(F.count(F.lit(1)).alias("readings"))
        .withColumn("meter_index", C.meter_index(F.col("meter_id")))
    )


def shard_assignment(spark, sf):
    return readings(spark, sf).groupBy("meter_id", "shard_id", "collector_id").agg(
        F.count(F.lit(1)).alias("readings")
    )


def shard_ranges(spark, sf):
    """The range of each shard next to what the readings show of it."""
    total = adapters.events(spark, sf).agg(F.max("user_id") + 1).first()[0] or 0
    used = readings(spark, sf).groupBy("shard_id").agg(
        F.min("meter_index").alias("lowest_meter"),
        F.max("meter_index").alias("highest_meter"),
        F.count(F.lit(1)).alias("readings"),
    )
    ranges = C.shard_ranges(spark, total, adapters.SHARDS)
    return used.join(ranges, "shard_id").select(
        "shard_id",
        F.col("start").alias("range_start"),
        F.col("end").alias("range_end"),
        "lowest_meter",
        "highest_meter",
        "readings",
    )


def meter_slice(spark, sf):
    return C.meters_in_range(readings(spark, sf), *SLICE).select("event_id", "meter_id", "kwh")


def meter_lookup(spark, sf):
    return C.meter(readings(spark, sf), METER).select("event_id", *READING.fieldNames())


def load_bands(spark, sf):
    return C.with_load_band(readings(spark, sf)).select(
        "event_id", "load_band", "load_factor", "normal_kwh"
    )


def derived_current(spark, sf):
    gaps = F.when(F.col("event_id") % 5 != 0, F.col("current"))
    return C.fill_current(readings(spark, sf).withColumn("current", gaps)).select(
        "event_id", "current"
    )


def time_roundtrip(spark, sf):
    micros = C.to_micros(F.col("ts"))
    return adapters.events(spark, sf).select(
        "event_id",
        micros.alias("micros"),
        C.from_micros(micros).alias("from_micros"),
        C.to_rfc3339(F.col("ts")).alias("rfc3339"),
        C.from_rfc3339(C.to_rfc3339(F.col("ts"))).alias("from_rfc3339"),
    )


# --- envelopes ----------------------------------------------------------------------


def _defective(day: Column) -> Column:
    """The text `value`, malformed in one of seven ways on six days of seven, by the day."""
    text = F.col("value").cast("string")
    defects = [
        F.expr("substring(cast(value as string), 1, length(value) - 1)"),
        F.concat(text, F.lit(" trailing")),
        F.concat(text, text),
        F.translate(text, '"', "'"),
        F.concat(F.lit("["), text, F.lit("]")),
        F.lit(""),
    ]
    which = F.pmod(day, F.lit(7))
    chosen = text
    for k, defect in enumerate(defects):
        chosen = F.when(which == k, defect).otherwise(chosen)
    return chosen


def parse_envelopes(spark, sf):
    """Array envelopes of the whole table; on six days of seven they have a defect."""
    sent = _kafka_shaped(envelopes.to_kafka_rows(envelopes.nest_array(stored_metrics(spark, sf))))
    micros = F.get_json_object(F.col("value").cast("string"), "$.window_start").cast("bigint")
    broken = _defective(F.floor(micros / F.lit(86_400_000_000))).cast("binary")
    good, bad = envelopes.parse_array_envelopes(sent.withColumn("value", broken))
    outcome = good.select(
        F.lit("parsed").alias("outcome"), "collector_id", "total_count", F.size("metrics").alias("n")
    ).unionAll(
        bad.select(
            F.lit("dead letter"),
            F.col("key").cast("string"),
            F.lit(0).cast("bigint"),
            F.lit(0),
        )
    )
    return outcome.groupBy("outcome", "collector_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum("total_count").alias("readings"),
        F.sum("n").alias("metrics"),
    )


def nested_envelopes(spark, sf):
    nested = envelopes.nest_array(stored_metrics(spark, sf))
    meters = F.transform("metrics", lambda m: m["meter_id"])
    return nested.select(
        *WINDOW_KEYS,
        "part",
        "total_count",
        F.size("metrics").cast("bigint").alias("num_meters"),
        F.array_join(meters, ",").alias("meters"),
    )


def explode_metrics(spark, sf):
    rows = envelopes.explode_metrics(envelopes.nest_array(stored_metrics(spark, sf)))
    return rows.select("total_count", *_METRIC_TABLE)


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """Six decimals: what remains the same however an engine adds or interpolates doubles."""
    return df.withColumn(column, F.rint(F.col(column) * 1e6) / F.lit(1e6))


def envelope_totals(spark, sf):
    totals = envelopes.with_envelope_totals(envelopes.nest_array(stored_metrics(spark, sf)))
    return _rounded(totals, "total_kwh").select(
        *WINDOW_KEYS, "total_count", "total_kwh", "num_meters"
    )


def envelope_summary(spark, sf):
    summary = envelopes.envelope_summary(envelopes.nest_map(stored_metrics(spark, sf)))
    return _rounded(_rounded(summary, "total_kwh"), "mean_of_avg_kwh")


# Every window of the test tables fits one message. These force parts of five meters, through
# both forms of the wire, and give what whole envelopes give.


def _split(spark: SparkSession, sf: str) -> DataFrame:
    sent = envelopes.to_kafka_rows(envelopes.nest_array(stored_metrics(spark, sf), SPLIT))
    return envelopes.parse_array_envelopes(_kafka_shaped(sent))[0]


def _split_map(spark: SparkSession, sf: str) -> DataFrame:
    sent = envelopes.to_map_json(envelopes.nest_map(stored_metrics(spark, sf), SPLIT))
    return envelopes.parse_map_envelopes(sent)[0]


def split_envelopes(spark, sf):
    """The parts themselves."""
    parts = _split(spark, sf)
    return parts.select(*WINDOW_KEYS, "part", "total_count", F.size("metrics").alias("num_meters"))


def split_kafka_rows(spark, sf):
    rows = envelopes.explode_metrics(_split(spark, sf))
    return rows.select(F.col("collector_id").alias("message_key"), "total_count", *_METRIC_TABLE)


def split_map_envelopes(spark, sf):
    return envelopes.explode_metrics(_split_map(spark, sf)).select("total_count", *_METRIC_TABLE)


def split_envelope_totals(spark, sf):
    totals = envelopes.with_envelope_totals(_split(spark, sf))
    return _rounded(totals, "total_kwh").select(
        *WINDOW_KEYS, "total_count", "total_kwh", "num_meters"
    )


def split_envelope_summary(spark, sf):
    summary = envelopes.envelope_summary(_split_map(spark, sf))
    return _rounded(_rounded(summary, "total_kwh"), "mean_of_avg_kwh")


def split_dataset_info(spark, sf):
    """Parts appended to a dataset in two goes, counted as windows."""
    path = new_path(spark, "dataset")
    parts = written(envelopes.nest_array(stored_metrics(spark, sf), SPLIT), "parts")
    files.append_envelopes(parts.filter("shard_id % 2 = 0"), path)
    files.append_envelopes(parts.filter("shard_id % 2 <> 0"), path)
    return rollups.dataset_info(spark.read.schema(parts.schema).parquet(path))


def split_service_stats(spark, sf):
    return rollups.service_stats(_split(spark, sf))


# --- windows ------------------------------------------------------------------------


def tumbling_time(spark, sf):
    return metrics(spark, sf)


def tumbling_count(spark, sf):
    return windows.tumble_count(valid(spark, sf), COUNT_WINDOW, exact=True)


def tumbling_hybrid(spark, sf):
    return _hybrid(spark, sf)


def contiguous_windows(spark, sf):
    emitted = written(envelopes.summarize(_hybrid(spark, sf), exact=True), "windows")
    return windows.contiguous_bounds(emitted)


def anomalies(spark, sf):
    return windows.with_anomaly(readings(spark, sf)).select("event_id", "meter_id", "anomaly_code")


# No meter or shard of the test tables is large. These force the way for large groups.


def split_anomalies(spark, sf):
    coded = windows.with_anomaly(readings(spark, sf), group_rows=SPLIT_ROWS)
    return coded.select("event_id", "meter_id", "anomaly_code")


def split_count(spark, sf):
    return windows.tumble_count(
        valid(spark, sf), COUNT_WINDOW, exact=True, group_rows=SPLIT_ROWS
    )


def split_hybrid(spark, sf):
    return windows.tumble_hybrid(
        valid(spark, sf), *HYBRID, exact=True, group_rows=SPLIT_ROWS
    )


def latest_n(spark, sf):
    return windows.latest_n(summaries(spark, sf), LATEST)


def sliding_analysis(spark, sf):
    return windows.slide(valid(spark, sf), *SLIDE, exact=True)


# --- reports ------------------------------------------------------------------------


def meter_metrics(spark, sf):
    return windows.aggregate_meters(valid(spark, sf), ["meter_id"], exact=True)


def merge_meter_metrics(spark, sf):
    return rollups.merge_metrics(metrics(spark, sf), exact=True)


def energy_report(spark, sf):
    return rollups.energy_report(metrics(spark, sf), exact=True)


def flat_summary(spark, sf):
    return rollups.flat_summary(metrics(spark, sf), exact=True)


def by_collector(spark, sf):
    return rollups.by_collector(metrics(spark, sf), exact=True)


def dashboard_kpis(spark, sf):
    return rollups.kpis(stored_metrics(spark, sf), LATEST, exact=True)


def collector_stats(spark, sf):
    return rollups.collector_stats(summaries(spark, sf), exact=True)


def meter_table(spark, sf):
    return rollups.meter_table(metrics(spark, sf), exact=True)


def top_meters(spark, sf):
    return rollups.top_meters(metrics(spark, sf), TOP, exact=True)


def reading_rate(spark, sf):
    return rollups.reading_rate(summaries(spark, sf), LATEST)


def energy_series(spark, sf):
    return rollups.energy_series(summaries(spark, sf), LATEST)


def meter_histogram(spark, sf):
    table = rollups.merge_metrics(metrics(spark, sf), exact=True)
    means = table.select((F.col("sum_kwh") / F.col("count")).alias("avg_kwh"))
    return profile.histogram(written(means, "means"), "avg_kwh")


def service_stats(spark, sf):
    return rollups.service_stats(summaries(spark, sf))


def windows_per_collector(spark, sf):
    return rollups.windows_per_collector(summaries(spark, sf))


def latest_window(spark, sf):
    return rollups.latest_window(_arrived(spark, sf))


def active_collectors(spark, sf):
    return rollups.active_collectors(summaries(spark, sf), ttl=TTL)


def validation_counts(spark, sf):
    return rollups.validation_counts(readings(spark, sf))


def throughput(spark, sf):
    return rollups.throughput(metrics(spark, sf))


def periodic_report(spark, sf):
    return rollups.periodic_report(metrics(spark, sf), REPORT, exact=True)


def distribution_stats(spark, sf):
    stats = profile.distribution(readings(spark, sf), ["collector_id"], "kwh", exact=True)
    for quantile in profile.QUANTILES:
        stats = _rounded(stats, quantile)
    return stats


def compare_runs(spark, sf):
    runs = adapters.runs(spark, sf)
    return profile.compare_runs(runs, "click", "view", exact=True)


def comparison_range(spark, sf):
    return profile.comparison_range(compare_runs(spark, sf))


def _zoneless(query: Query) -> Query:
    """Fix the session zone and give times as wall-clock time."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        result = query(spark, sf_dir)
        times = [f.name for f in result.schema if isinstance(f.dataType, T.TimestampType)]
        return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


_BATCH = [
    scan_readings, readings_roundtrip, json_readings, upsert_latest, stored_anomalies, store_meter_range, store_time_range, meter_range_scan, time_range_scan,
    kafka_rows, map_envelopes, default_rows, map_dead_letters, flat_metrics, metrics_roundtrip, dataset_info,
    validate_codes, power_check, valid_readings, rejected_readings, error_messages,
    meter_ids, shard_assignment, shard_ranges, meter_slice, meter_lookup,
    load_bands, derived_current, time_roundtrip,
    parse_envelopes, nested_envelopes, explode_metrics, envelope_totals, envelope_summary,
    split_envelopes, split_kafka_rows, split_map_envelopes, split_envelope_totals,
    split_envelope_summary, split_dataset_info, split_service_stats,
    tumbling_time, tumbling_count, tumbling_hybrid, contiguous_windows,
    anomalies, split_anomalies, split_count, split_hybrid, latest_n, sliding_analysis,
    meter_metrics, merge_meter_metrics, energy_report, flat_summary, by_collector,
    dashboard_kpis, collector_stats, meter_table, top_meters, reading_rate, energy_series,
    meter_histogram, service_stats, windows_per_collector, latest_window, active_collectors,
    validation_counts, throughput, periodic_report, distribution_stats, compare_runs, comparison_range,
]


def queries() -> dict[str, Query]:
    return {q.__name__: _zoneless(q) for q in [*_BATCH, *streamed.QUERIES]}
