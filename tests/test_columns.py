import datetime as dt

import pytest
from conftest import at, since
from pyspark.sql import functions as F

from wattlake.functions import columns as C


def test_meter_ids(spark):
    frame = spark.createDataFrame([(0,), (42,), (9999,), (12345,)], "i bigint")
    rows = frame.withColumn("id", C.meter_id(F.col("i"))).withColumn(
        "back", C.meter_index(F.col("id"))
    )
    got = rows.orderBy("i").collect()
    assert [r.id for r in got] == ["METER-0000", "METER-0042", "METER-9999", "METER-12345"]
    assert [r.back for r in got] == [0, 42, 9999, 12345]
    assert spark.range(1).select(C.meter_index(F.lit("METER-x"))).first()[0] is None


@pytest.mark.parametrize(
    "total, num, expected",
    [
        (10, 4, [(0, 0, 3), (1, 3, 6), (2, 6, 9), (3, 9, 10)]),
        (8, 4, [(0, 0, 2), (1, 2, 4), (2, 4, 6), (3, 6, 8)]),
        (5, 4, [(0, 0, 2), (1, 2, 4), (2, 4, 5)]),
        (2, 4, [(0, 0, 1), (1, 1, 2)]),
        (0, 4, []),
    ],
)
def test_shard_ranges(spark, total, num, expected):
    ranges = [tuple(r) for r in C.shard_ranges(spark, total, num).orderBy("shard_id").collect()]
    assert ranges == expected
    meters = spark.range(total).withColumnRenamed("id", "meter_index")
    for row in C.with_shard(meters, total, num).collect():
        shard = next(s for s, start, end in expected if start <= row.meter_index < end)
        assert row.shard_id == shard


def test_shards_must_be_positive(spark):
    with pytest.raises(ValueError):
        C.shard_ranges(spark, 10, 0)


def test_slice_clamps(spark):
    meters = spark.range(10).withColumnRenamed("id", "meter_index")
    assert C.meters_in_range(meters, -5, 3).count() == 3
    assert C.meters_in_range(meters, 8, 50, total=10).count() == 2
    assert C.meters_in_range(meters, 5, 5).count() == 0


def test_lookup(make):
    rows = make([(0, 1, 0, 1.0), (1, 2, 0, 1.0)])
    assert C.meter(rows, "METER-0002").count() == 1
    assert C.meter(rows, "METER-0099").count() == 0


def test_load_bands(make):
    rows = make([(h, 0, h * 3600, 3.0) for h in range(24)])
    got = {r.event_id: (r.load_band, r.load_factor) for r in C.with_load_band(rows).collect()}
    for hour in range(24):
        if hour < 6:
            assert got[hour] == ("night", 0.6)
        elif hour < 9:
            assert got[hour] == ("morning", 1.3)
        elif 18 <= hour < 22:
            assert got[hour] == ("evening", 1.5)
        else:
            assert got[hour] == ("day", 1.0)


def test_fill_current(make):
    rows = make([(0, 0, 0, 4.4, 220.0, None), (1, 0, 1, 4.4, 220.0, 7.0), (2, 0, 2, 4.4, 0.0, None)])
    assert [r.current for r in C.fill_current(rows).orderBy("event_id").collect()] == [20.0, 7.0, None]


def test_times(spark):
    texts = [
        ("2024-01-01T00:00:05.123456789Z", 5.123456),
        ("2024-01-01T02:00:05+02:00", 5.0),
        ("2024-01-01T00:00:05Z", 5.0),
        ("no time", None),
    ]
    frame = spark.createDataFrame(texts, "text string, want double")
    for row in frame.withColumn("ts", C.from_rfc3339(F.col("text"))).collect():
        assert (row.ts is None and row.want is None) or since(row.ts) == pytest.approx(row.want)
    micros = spark.range(1).select(C.from_micros(F.lit(1704067205123456)).alias("ts"))
    assert since(micros.first().ts) == pytest.approx(5.123456)
    assert micros.select(C.to_micros(F.col("ts"))).first()[0] == 1704067205123456
    assert micros.select(C.to_rfc3339(F.col("ts"))).first()[0] == "2024-01-01T00:00:05.123456Z"


def test_instant_is_utc(spark):
    zoned = dt.datetime(2024, 1, 1, 2, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    for moment in (dt.datetime(2024, 1, 1), "2024-01-01", "2024-01-01T00:00:00Z", zoned, at(0)):
        assert spark.range(1).select(F.unix_seconds(C.instant(moment))).first()[0] == 1704067200


def test_rfc3339_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        text = spark.range(1).select(C.to_rfc3339(F.timestamp_micros(F.lit(0))).alias("t"))
        assert text.first().t == "1970-01-01T09:00:00.000000+09:00"
        assert text.select(F.unix_micros(C.from_rfc3339(F.col("t")))).first()[0] == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
