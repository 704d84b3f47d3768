"""Streams with keyed state: the reading before, and time-or-count windows.

The state is Spark's own (`transformWithState` on RocksDB, see `run.use_rocksdb`): checkpointed with
the stream's offsets, so that a restart or a repeated batch goes on from what belongs to it. A key
keeps one reading, or the readings of its open window, never its history.

Rows of a key are ordered within a micro-batch. The results equal those of the batch operators for
batches that arrive in order of time. The order of a meter's or source's readings is a sequence, so
one task handles a key's rows of a micro-batch; the size of a trigger bounds it. Measures are not
computed there: windows leave as tagged readings, and built-in aggregates combine them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattlake.functions.rules import anomaly_code, valid_only
from wattlake.operators.windows import hybrid_bounds, metric_columns, seconds, tumble_hybrid
from wattlake.schemas import SOURCE_KEYS
from wattlake.streaming.run import Sink

# What makes the order of readings unique, where the caller says nothing else.
ORDER = ("ts", "event_id")


def _sorted(rows: Iterator[Row], order: Sequence[str]) -> list[Row]:
    """Rows in order, nulls first."""
    return sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in order))


# --- previous reading ---------------------------------------------------------------


class PreviousReading(StatefulProcessor):
    """Adds the kwh and voltage of the reading before, of the same meter."""

    def __init__(self, order: Sequence[str], ttl_ms: int | None, columns: list[str]):
        self.order, self.ttl_ms, self.columns = order, ttl_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "kwh double, voltage double", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = Row(*self.columns)
        before = self.last.get() if self.last.exists() else (None, None)
        for row in _sorted(rows, self.order):
            yield out(*row, *before)
            before = (row["kwh"], row["voltage"])
        self.last.update(before)

    def close(self) -> None:
        pass


def anomaly_stream(
    readings: DataFrame, order: Sequence[str] = ORDER, nan: str = "reject", ttl: str | None = None
) -> DataFrame:
    """`windows.with_anomaly` on a stream, in append mode.

    A reading is compared with the one that arrived before it, also if it is late. With a `ttl`, a
    meter that was silent for so long (by the clock) starts anew, and its state is freed; such a stream
    always has another batch, so it needs a periodic trigger and runs until it is stopped.
    """
    added = [T.StructField(name, T.DoubleType()) for name in ("_kwh", "_voltage")]
    schema = T.StructType([*readings.schema.fields, *added])
    ttl_ms = seconds(ttl) * 1000 if ttl else None
    linked = readings.groupBy("meter_id").transformWithState(
        PreviousReading(tuple(order), ttl_ms, schema.names), schema, "Append", "ProcessingTime" if ttl else "None"
    )
    previous = F.struct(F.col("_kwh").alias("kwh"), F.col("_voltage").alias("voltage"))
    coded = linked.withColumn("_prev", previous).withColumn("anomaly_code", anomaly_code("_prev", nan))
    return coded.drop("_prev", "_kwh", "_voltage")


# --- time-or-count windows ----------------------------------------------------------

#: Window number of a reading that came after its period had closed.
LATE = -1
_READING = "event_id bigint, meter_id string, ts timestamp, kwh double, voltage double, current double"
_TAGS = "shard_id int, collector_id string, _start bigint, window_seq bigint, _full boolean"
_FIELDS = [field.split()[0] for field in _READING.split(", ")]
_Tagged = Row(*[field.split()[0] for field in f"{_TAGS}, {_READING}".split(", ")])


class CountedWindows(StatefulProcessor):
    """Readings of a source, given out when the window that they are in closes.

    State: how many readings each open period has had, and the readings of its open window, fewer
    than `n`. A timer closes a period when the watermark passes its end.
    """

    def __init__(self, period: int | None, n: int, order: Sequence[str]):
        self.period, self.n, self.order = period, n, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "start bigint", "n bigint")
        self.open = handle.getMapState("open", "start bigint, position bigint", _READING)

    def held(self, start: int, seen: int) -> list[tuple]:
        """The readings of the open window, which leave the state."""
        found = []
        for position in range(seen - seen % self.n, seen):
            found.append(tuple(self.open.getValue((start, position))))
            self.open.removeKey((start, position))
        return found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        periods = defaultdict(list)
        for row in rows:
            periods[row["_start"]].append(row)
        for start, some in sorted(periods.items()):
            some = [tuple(row[c] for c in _FIELDS) for row in _sorted(some, self.order)]
            if self.period and start // 1000 + self.period * 1000 <= timerValues.getCurrentWatermarkInMs():
                yield from (_Tagged(*key, start, LATE, False, *reading) for reading in some)
                continue
            known = self.seen.containsKey((start,))
            seen = self.seen.getValue((start,))[0] if known else 0
            if not known and self.period:
                self.handle.registerTimer(start // 1000 + self.period * 1000)
            number, upto = seen // self.n, seen + len(some)
            if upto // self.n > number:
                some = self.held(start, seen) + some
                for number in range(number, upto // self.n):
                    full, some = some[: self.n], some[self.n :]
                    yield from (_Tagged(*key, start, number, True, *reading) for reading in full)
            for back, reading in enumerate(reversed(some), 1):
                self.open.updateValue((start, upto - back), reading)
            self.seen.updateValue((start,), (upto,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = (expiredTimerInfo.getExpiryTimeInMs() - self.period * 1000) * 1000
        if self.seen.containsKey((start,)):
            seen = self.seen.getValue((start,))[0]
            yield from (_Tagged(*key, start, seen // self.n, False, *reading) for reading in self.held(start, seen))
            self.seen.removeKey((start,))

    def close(self) -> None:
        pass


def hybrid_stream(
    readings: DataFrame, duration: str | None, n: int, delay: str = "1 minute", order: Sequence[str] = ORDER
) -> DataFrame:
    """The valid readings of closed time-or-count windows, for `hybrid_sink`.

    A window closes with its n-th reading, or when the watermark passes the end of its period; with
    `duration` None only the count closes windows. All readings of a window come in one batch. Those
    of a closed period come at once, with the window number LATE: none is dropped, so the
    watermark's column is replaced by its microseconds, which Spark doesn't filter by.
    """
    if n < 1:
        raise ValueError("without a count, use ingest.metric_stream")
    valid = valid_only(readings).withColumn("ts", F.col("ts").cast("timestamp"))
    start = F.unix_micros(F.window("ts", duration)["start"]) if duration else F.lit(0).cast("bigint")
    rows = valid.withColumn("_start", start).withWatermark("ts", delay)
    plain = [F.timestamp_micros(F.unix_micros("ts")).alias("ts"), *[c for c in _FIELDS if c != "ts"]]
    return rows.select(*SOURCE_KEYS, "_start", *plain).groupBy(*SOURCE_KEYS).transformWithState(
        CountedWindows(seconds(duration) if duration else None, n, tuple(order)), f"{_TAGS}, {_READING}", "Append",
        "EventTime" if duration else "None",
    )


def closed_windows(tagged: DataFrame, duration: str | None, exact: bool = False) -> DataFrame:
    """The metrics of the windows in a batch of `hybrid_stream`, like `windows.tumble_hybrid`."""
    keys = [*SOURCE_KEYS, "_start", "window_seq"]
    rows = tagged.filter(F.col("window_seq") != LATE).withColumn("_start", F.timestamp_micros("_start"))
    metrics = rows.groupBy(*keys, "_full", "meter_id").agg(*metric_columns(exact))
    whole = W.partitionBy(*keys)
    bounded = metrics.withColumns(
        {"_from": F.min("first_reading").over(whole), "_to": F.max("last_reading").over(whole)}
    )
    return hybrid_bounds(bounded, duration)


def late_readings(tagged: DataFrame) -> DataFrame:
    """The readings in a batch of `hybrid_stream` that came after their period had closed."""
    return tagged.filter(F.col("window_seq") == LATE).select(*SOURCE_KEYS, *_FIELDS)


def hybrid_sink(windows: Sink, late: Sink, duration: str | None, exact: bool = False) -> Sink:
    """Closed windows into one sink, late readings into another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            windows(closed_windows(batch, duration, exact), batch_id)
            late(late_readings(batch), batch_id)
        finally:
            batch.unpersist()

    return write


def open_windows(
    readings: DataFrame, closed: DataFrame, late: DataFrame, duration: str | None, n: int, exact: bool = False
) -> DataFrame:
    """The windows a stopped stream left open, from the readings in storage: what `tumble_hybrid`
    makes of all but the late ones, less the windows that were given out."""
    in_time = readings.join(late.select("event_id"), "event_id", "left_anti")
    windows = tumble_hybrid(valid_only(in_time), duration, n, exact=exact)
    given = closed.select(*SOURCE_KEYS, "window_seq", "window_start").distinct()
    return windows.join(given, [*SOURCE_KEYS, "window_seq", "window_start"], "left_anti").select(windows.columns)
