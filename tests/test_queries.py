"""Registered queries: equal to DuckDB, and planned as intended."""

import re

import pytest
from check import ROOT, connection, difference

from __spark_entry__ import entry, oracle_sql, queries
from wattlake.plans import catalog, oracle

SF = f"{ROOT}/sf0.001"
QUERIES, ORACLES = catalog.queries(), oracle.statements()
ALONE = r"Window \[[^\n]*\n(?:[^\n]*Sort[^\n]*\n)?[^\n]*Exchange SinglePartition"
BATCH = [name for name in QUERIES if not name.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).first().total_readings == 192


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_duckdb(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    if name in BATCH:
        text = plan(frame)
        assert not re.search(r"CartesianProduct|NestedLoop|Python|Pandas", text)
        assert not re.search(ALONE, text)
    got, want = frame.toPandas(), duck.execute(ORACLES[name]).df()
    assert len(got) > 0
    assert difference(got, want) is None


@pytest.mark.parametrize("name", ["meter_range_scan", "time_range_scan"])
def test_time_filters_reach_the_scan(spark, name):
    pushed = plan(QUERIES[name](spark, SF)).split("PushedFilters: [")[1].split("]")[0]
    assert re.search(r"GreaterThan(OrEqual)?\(ts,", pushed) and "LessThan(ts," in pushed


@pytest.mark.parametrize("name", ["meter_range_scan", "meter_lookup"])
def test_meter_filters_reach_the_scan(spark, name):
    pushed = plan(QUERIES[name](spark, SF)).split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(user_id,7)" in pushed


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["meter_table"](spark, SF))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all("props" not in columns and "event_type" not in columns for columns in read)


@pytest.mark.parametrize(
    "name", ["energy_report", "periodic_report", "throughput", "flat_summary", "by_collector"]
)
def test_reports_scan_the_readings_once(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert len(re.findall(r"FileScan parquet \[event_id", text)) == 1


def test_metrics_are_aggregated_before_the_shuffle(spark):
    text = plan(QUERIES["tumbling_time"](spark, SF))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_count(1)" in below
    assert len(re.findall("Exchange hashpartitioning", text)) == 1
