"""Starting streams, and what a micro-batch is handed to.

Sinks are functions (batch, batch_id). A batch may be handed over again after a failure;
sinks that write under the batch id make that harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from wattlake.operators.envelopes import array_envelopes, malformed, with_decoded
from wattlake.operators.windows import tumble
from wattlake.sources import shared
from wattlake.sources.files import write_readings

Sink = Callable[[DataFrame, int], None]


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams that start from now on in RocksDB; keyed state needs it."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def with_trigger(writer: DataStreamWriter, every: str | None = None) -> DataStreamWriter:
    """Refresh every so often, or, without a period, work off what is there and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_table(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the rows that are final to a Parquet table, each exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def to_sink(
    stream: DataFrame,
    sink: Sink,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def run_available_now(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append"):
    """Work off all input that is there; the query has ended when this returns."""
    query = to_sink(stream, sink, checkpoint, mode=mode)
    query.awaitTermination()
    return query


def table_sink(path: str) -> Sink:
    """Write each batch as its own partition; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def readings_sink(path: str) -> Sink:
    """Append readings to the store, ordered by batch.

    A repeated batch appends the same readings under the same order again, which
    `stored.upsert_latest` reduces to one on reading, like any second write of a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_readings(batch, path, order=F.lit(batch_id))

    return write


class BucketTable:
    """A table of rows with a key, into which batches of changed rows are merged.

    The keys are dealt into buckets by a hash. A batch writes the buckets anew that it touches, in a
    folder of its number, and then a list of the folders that make up the table; the list is what
    commits the batch. A repeated batch starts from the list before it. Folders that neither of the
    last two lists names are removed, so the table takes no more room for more batches.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets

    def _lists(self) -> list[int]:
        return sorted(int(x.rpartition("=")[2]) for x in shared.names(self.spark, f"{self.path}/lists"))

    def _list(self, batch_id: int) -> dict[int, int]:
        rows = self.spark.read.schema("bucket int, batch bigint").json(f"{self.path}/lists/batch={batch_id}")
        return {r.bucket: r["batch"] for r in rows.collect()}  # a row for each bucket

    def _read(self, folders: dict[int, int], schema: T.StructType) -> DataFrame | None:
        paths = [f"{self.path}/rows/batch={n}/in_bucket={b}" for b, n in folders.items()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        changed = batch.withColumn("in_bucket", bucket).persist()
        try:
            touched = [r[0] for r in changed.select("in_bucket").distinct().collect()]
            lists = self._lists()
            earlier = [n for n in lists if n < batch_id]
            folders = self._list(earlier[-1]) if earlier else {}
            old = self._read({b: n for b, n in folders.items() if b in touched}, batch.schema)
            new = changed
            if old is not None:
                same = [F.col(f"o.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys]
                kept = old.alias("o").join(changed.alias("c"), same, "left_anti")
                new = changed.unionByName(kept.withColumn("in_bucket", bucket))
            rows = new.repartition("in_bucket").write.partitionBy("in_bucket")
            rows.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
            folders |= {b: batch_id for b in touched}
            listed = self.spark.createDataFrame(sorted(folders.items()), "bucket int, batch bigint")
            listed.coalesce(1).write.mode("overwrite").json(f"{self.path}/lists/batch={batch_id}")
        finally:
            changed.unpersist()
        used = set(folders.items()) | (set(self._list(earlier[-1]).items()) if earlier else set())
        for folder in shared.names(self.spark, f"{self.path}/rows"):
            parts = shared.names(self.spark, f"{self.path}/rows/{folder}")
            number = int(folder.rpartition("=")[2])
            idle = [x for x in parts if (int(x.rpartition("=")[2]), number) not in used]
            for name in idle if len(idle) < len(parts) else [""]:
                shared.remove(self.spark, f"{self.path}/rows/{folder}/{name}".rstrip("/"))
        for number in earlier[:-1]:
            shared.remove(self.spark, f"{self.path}/lists/batch={number}")

    def read(self, schema: T.StructType) -> DataFrame:
        """The table after the last batch that was committed."""
        lists = self._lists()
        found = self._read(self._list(lists[-1]), schema) if lists else None
        return self.spark.createDataFrame([], schema) if found is None else found


def fan_out(*sinks: Sink, ledger: str | None = None) -> Sink:
    """One stream into several sinks; the batch is computed once.

    With a `ledger`, a folder, each sink's last batch is noted there when it is through: a batch that
    is repeated because a later sink failed goes only to the sinks that have not had it. A sink that
    fails within its own work gets the batch again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            for number, sink in enumerate(sinks):
                note = f"{ledger}/sink={number}"
                if ledger and f"batch={batch_id}" in shared.names(spark, note):
                    continue
                sink(batch, batch_id)
                if ledger:
                    shared.touch(spark, f"{note}/batch={batch_id}")
                    for name in shared.names(spark, note):
                        if int(name.rpartition("=")[2]) < batch_id:
                            shared.remove(spark, f"{note}/{name}")
        finally:
            batch.unpersist()

    return write


def envelope_sink(good: Sink, bad: Sink) -> Sink:
    """Decode Kafka-shaped rows; malformed ones go to the dead letters, the stream goes on."""

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = with_decoded(batch).persist()
        try:
            good(array_envelopes(decoded), batch_id)
            bad(malformed(decoded), batch_id)
        finally:
            decoded.unpersist()

    return write


class LateRows(StreamingQueryListener):
    """Counts the rows that built-in aggregates drop as late, over the whole life of each query.

    `spark.streams.addListener(LateRows())`; `dropped` maps the id of a query, which restarts keep,
    to its rows. `stateful.hybrid_stream` drops none: it gives late readings out.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        found = sum(x.numRowsDroppedByWatermark for x in event.progress.stateOperators)
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def final_flush(
    readings: DataFrame, closed: DataFrame, duration: str, exact: bool = False
) -> DataFrame:
    """The windows a stopped stream left open, as metrics, from the readings in storage.

    All windows that end by the last emitted end are closed, so the rest of the readings is
    what is not earlier than that. The end is looked up first: as a literal it prunes dates
    and reaches the scan.
    """
    end = closed.agg(F.max(F.unix_micros("window_end"))).first()[0]
    if end is None:
        return tumble(readings, duration, exact)
    last = F.timestamp_micros(F.lit(end))
    if "date" in readings.columns:
        readings = readings.filter(F.col("date") >= F.to_date(last))
    return tumble(readings.filter(F.col("ts") >= last), duration, exact)
