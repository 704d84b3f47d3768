import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wattlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "wattlake-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Readings from tuples (event_id, meter_index, second, kwh[, voltage, current])."""
    from wattlake.functions import columns as C
    from pyspark.sql import functions as F

    def build(rows, total=8, shards=2):
        full = []
        for event_id, meter, second, kwh, *rest in rows:
            voltage = rest[0] if rest else 220.0
            current = rest[1] if len(rest) > 1 else kwh * 1000.0 / voltage
            full.append((event_id, meter, at(second), kwh, voltage, current))
        frame = spark.createDataFrame(
            full,
            "event_id bigint, meter_index bigint, ts timestamp, kwh double, voltage double, "
            "current double",
        ).withColumn("meter_id", C.meter_id(F.col("meter_index")))
        sharded = C.with_shard(frame, total, shards)
        return sharded.withColumn("collector_id", C.collector_id(F.col("shard_id")))

    return build


EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(second: float) -> dt.datetime:
    return EPOCH + dt.timedelta(seconds=second)


def since(moment: dt.datetime) -> float:
    """Seconds since EPOCH of a collected (UTC wall-clock) time."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return (moment - EPOCH).total_seconds()
