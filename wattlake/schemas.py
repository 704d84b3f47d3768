"""Fixed schemas. Nothing in this package infers a schema."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(fields: str) -> T.StructType:
    """`StructType.fromDDL` needs a running session; schemas exist before one does."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


READING = _struct(
    "meter_id string, ts timestamp, kwh double, voltage double, current double"
)

# Field names and order of the JSON wire formats.
READING_JSON = _struct(
    "meter_id string, timestamp timestamp, kwh double, voltage double, current double"
)

_MEASURES = (
    "count bigint, sum_kwh double, avg_kwh double, min_kwh double, max_kwh double, "
    "avg_voltage double, avg_current double"
)

METRIC = _struct(
    f"meter_id string, {_MEASURES}, first_reading timestamp, last_reading timestamp"
)
METRIC_WIRE = _struct(
    f"meter_id string, {_MEASURES}, first_reading bigint, last_reading bigint"
)


WHOLE = _struct(
    "total_count bigint, num_meters bigint, total_kwh double, sum_of_avg_kwh double"
)


def _envelope(time_type: str, metrics: T.DataType) -> T.StructType:
    head = _struct(
        f"window_start {time_type}, window_end {time_type}, shard_id int, "
        "collector_id string, total_count bigint"
    )
    # `part` numbers the pieces of an envelope too large for one message, and `whole` says what
    # the window has in all; producers that do not split leave them out, and part counts as 0.
    return head.add("metrics", metrics).add("part", T.IntegerType()).add("whole", WHOLE)


MAP_ENVELOPE = _envelope("timestamp", T.MapType(T.StringType(), METRIC))
ARRAY_ENVELOPE = _envelope("bigint", T.ArrayType(METRIC_WIRE))

FLAT_METRIC = _struct(
    "window_start timestamp, window_end timestamp, collector_id string, shard_id int, "
    f"meter_id string, {_MEASURES}"
)

KAFKA_ROW = _struct(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

RUN = _struct(
    "language string, meters bigint, iterations bigint, total_readings bigint, "
    "duration_ms double, readings_per_sec double, avg_us_per_read double, "
    "peak_mem_mb double, avg_cpu_percent double, window_flushes bigint"
)

# The driver's input table. Its `ts` carries no zone; read as UTC it needs no cast,
# so that time filters reach the scan and streams can put a watermark on it.
EVENTS = _struct(
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)

SOURCE_KEYS = ["shard_id", "collector_id"]
WINDOW_KEYS = ["window_start", "window_end", *SOURCE_KEYS]
METRIC_FIELDS = METRIC.fieldNames()


def window_keys(df) -> list[str]:
    """Columns that identify one window; count windows add their sequence number."""
    return WINDOW_KEYS + [c for c in ("window_seq",) if c in df.columns]
