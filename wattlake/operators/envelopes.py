"""Envelopes: the nested form of a window on the wire, and the ways in and out of it.

In tables, windows are flat metric rows; they are nested only to be sent. A window with more
meters than fit one message becomes several envelopes with the same bounds, parts 0, 1, ... in
the order of meters, each with the readings of its own meters as `total_count`. Other windows
stay in one part. Every part of a split window also carries what the whole window has (`whole`),
so that what is read from parts is the same as from one envelope: `explode_metrics` gives the
window's count, and totals and summaries have one row per window, made from part 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.columns import from_micros, to_micros
from wattlake.functions.strict_json import with_body
from wattlake.operators import ordered
from wattlake.operators.windows import total
from wattlake.schemas import (
    ARRAY_ENVELOPE,
    FLAT_METRIC,
    MAP_ENVELOPE,
    METRIC,
    METRIC_FIELDS,
    window_keys,
)

# Fixed value: what stands for a collector that did not give its name.
UNKNOWN_COLLECTOR = "?"
MAX_METRICS = 2000


# --- nest ---------------------------------------------------------------------------


def dealt(metrics: DataFrame, parts: Column, keep: list[str]) -> DataFrame:
    """Metrics as structs `_m`, dealt into parts by a hash of the meter, for streams.

    A stream cannot number the meters of a window. `keep` names further columns.

    With several parts, each row also stands for its window in part 0: not with its metric, but
    with what it adds to the facts of the window, `_f`. These rows combine to one per window and
    task before they are shuffled.
    """
    added = F.struct(*[F.col(c) for c in ("count", "sum_kwh", "avg_kwh")])
    rows = metrics.select(
        *keep, F.struct(*METRIC_FIELDS).alias("_m"), added.alias("_f"), parts.alias("_parts")
    )
    own = F.expr("1 + pmod(xxhash64(_m.meter_id), _parts)").cast("int")
    slots = F.when(F.col("_parts") > 1, F.array(F.lit(0), own)).otherwise(F.array(F.lit(0)))
    spread = rows.withColumn("part", F.explode(slots))
    carries = (F.col("_parts") == 1) | (F.col("part") > 0)
    return spread.withColumns(
        {"_m": F.when(carries, F.col("_m")), "_f": F.when(~carries, F.col("_f"))}
    ).drop("_parts")


def dealt_facts(exact: bool = False) -> Column:
    """The aggregate that makes `whole` of dealt rows; only part 0 of a split window has it."""
    meters = F.count("_f")
    facts = F.struct(
        F.sum("_f.count").alias("total_count"),
        meters.alias("num_meters"),
        total("_f.sum_kwh", exact).alias("total_kwh"),
        total("_f.avg_kwh", exact).alias("sum_of_avg_kwh"),
    )
    return F.when(meters > 0, facts).alias("whole")


def with_facts(envelopes: DataFrame) -> DataFrame:
    """Give every part of a stored table of stream parts the facts that its part 0 has.

    On a stream, totals and summaries need part 0 only; `explode_metrics` needs all parts.
    """
    keys = window_keys(envelopes)
    known = envelopes.filter("part = 0 and whole is not null").select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("whole").alias("_whole")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    filled = F.coalesce(F.col("whole"), F.col("_whole"))
    rows = envelopes.join(known, same, "left").withColumn("whole", filled)
    return rows.select(envelopes.columns)


def envelope_columns(as_map: bool) -> list[Column]:
    """The aggregates that make an envelope of dealt rows."""
    if as_map:
        entry = F.when(F.col("_m").isNotNull(), F.struct(F.col("_m.meter_id"), F.col("_m")))
        packed = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    else:
        packed = F.sort_array(F.collect_list("_m"))
    count = F.sum(F.coalesce(F.col("_m.count"), F.lit(0).cast("bigint")))
    return [count.alias("total_count"), packed.alias("metrics")]


def numbered_parts(metrics: DataFrame, max_metrics: int = MAX_METRICS) -> DataFrame:
    """Metrics with their `part`, and `whole`: what the window has in all, null if it is one part.

    Meters are numbered within their window, so no part has more than `max_metrics`, and the
    parts of a window depend on nothing but the window.
    """
    keys = window_keys(metrics)
    facts = metrics.groupBy(*keys).agg(
        F.struct(
            F.sum("count").alias("total_count"),
            F.count(F.lit(1)).alias("num_meters"),
            F.sum("sum_kwh").alias("total_kwh"),
            F.sum("avg_kwh").alias("sum_of_avg_kwh"),
        ).alias("_facts")
    )
    rows = ordered.row_number(metrics, keys, ["meter_id"], "_position")
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    joined = rows.alias("m").join(facts.alias("f"), same).select("m.*", "f._facts")
    split = F.col("_facts.num_meters") > max_metrics
    part = F.expr(f"cast((_position - 1) div {int(max_metrics)} as int)")
    return joined.withColumns(
        {"part": part, "whole": F.when(split, F.col("_facts"))}
    ).drop("_position", "_facts")


def _nest(metrics: DataFrame, as_map: bool, max_metrics: int) -> DataFrame:
    keys = window_keys(metrics)
    rows = numbered_parts(metrics, max_metrics)
    rows = rows.select(*keys, "part", "whole", F.struct(*METRIC_FIELDS).alias("_m"))
    nested = rows.groupBy(*keys, "part").agg(*envelope_columns(as_map), F.first("whole").alias("whole"))
    return nested.select(*keys, "total_count", "metrics", "part", "whole")


def nest_array(metrics: DataFrame, max_metrics: int = MAX_METRICS) -> DataFrame:
    """One row per envelope, its metrics an array ordered by meter."""
    return _nest(metrics, False, max_metrics)


def nest_map(metrics: DataFrame, max_metrics: int = MAX_METRICS) -> DataFrame:
    """One row per envelope, its metrics a map from meter to metric."""
    return _nest(metrics, True, max_metrics)


# --- unnest -------------------------------------------------------------------------


def metric_array(envelopes: DataFrame) -> Column:
    """The metrics as an array, whichever form the envelope has."""
    metrics = F.col("metrics")
    if isinstance(envelopes.schema["metrics"].dataType, T.MapType):
        return F.map_values(metrics)
    return metrics


def explode_metrics(envelopes: DataFrame) -> DataFrame:
    """One row per (envelope, meter) with the window's count; metrics without a meter id are dropped.

    The outer form spares a test for empty arrays, which would compute the array twice; what
    it gives for them has no meter id.
    """
    keep = [c for c in envelopes.columns if c not in ("metrics", "part", "whole")]
    rows = envelopes.withColumn("total_count", _of_window(envelopes, "total_count", F.col("total_count")))
    rows = rows.select(*keep, F.explode_outer(metric_array(envelopes)).alias("_m"))
    return rows.filter("_m.meter_id is not null and _m.meter_id <> ''").select(*keep, "_m.*")


def flatten_metrics(envelopes: DataFrame) -> DataFrame:
    """The 12-column export table. No envelopes give an empty table."""
    return explode_metrics(envelopes).select(FLAT_METRIC.fieldNames())


# --- per-window measures --------------------------------------------------------------


def first_parts(envelopes: DataFrame) -> DataFrame:
    """One row per window: part 0. Tables without parts are windows already."""
    if "part" not in envelopes.columns:
        return envelopes
    return envelopes.filter(F.coalesce("part", F.lit(0)) == 0)


def _of_window(envelopes: DataFrame, field: str, own: Column) -> Column:
    """A fact of the whole window: `own` if the envelope is all of it."""
    if "whole" not in envelopes.columns:
        return own
    return F.coalesce(F.col(f"whole.{field}"), own)


def _sum_field(envelopes: DataFrame, field: str) -> Column:
    array = F.coalesce(F.transform(metric_array(envelopes), lambda m: m[field]), F.array())
    return F.aggregate(
        array.cast("array<double>"), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))
    )


def _size(envelopes: DataFrame) -> Column:
    return F.coalesce(F.size(metric_array(envelopes)), F.lit(0)).cast("bigint")


def with_envelope_totals(envelopes: DataFrame) -> DataFrame:
    """One row per window: add its energy and number of meters, also of split windows."""
    own = {"total_kwh": _sum_field(envelopes, "sum_kwh"), "num_meters": _size(envelopes)}
    own |= {"total_count": F.col("total_count")}
    return first_parts(envelopes).withColumns(
        {name: _of_window(envelopes, name, value) for name, value in own.items()}
    )


def envelope_summary(envelopes: DataFrame) -> DataFrame:
    """What the intake answers per window: readings, meters, energy, and the mean of the averages.

    The mean does not weight meters by their readings; 0 for a window without meters.
    """
    keys = window_keys(envelopes)
    count = _of_window(envelopes, "total_count", F.col("total_count"))
    meters = _of_window(envelopes, "num_meters", _size(envelopes))
    averages = _of_window(envelopes, "sum_of_avg_kwh", _sum_field(envelopes, "avg_kwh"))
    return first_parts(envelopes).select(
        *keys,
        count.alias("received_count"),
        meters.alias("meters_count"),
        _of_window(envelopes, "total_kwh", _sum_field(envelopes, "sum_kwh")).alias("total_kwh"),
        F.coalesce(F.try_divide(averages, meters), F.lit(0.0)).alias("mean_of_avg_kwh"),
    )


def summarize(metrics: DataFrame, exact: bool = False) -> DataFrame:
    """One row per window from a metric table, without nesting it first."""
    keys = window_keys(metrics)
    return metrics.groupBy(*keys).agg(
        F.sum("count").alias("total_count"),
        total("sum_kwh", exact).alias("total_kwh"),
        F.count(F.lit(1)).alias("num_meters"),
    )


def summarize_envelopes(envelopes: DataFrame) -> DataFrame:
    """One row per window from received envelopes; envelopes of one window are added up."""
    keys = window_keys(envelopes)
    return (
        with_envelope_totals(envelopes)
        .groupBy(*keys)
        .agg(
            F.sum("total_count").alias("total_count"),
            F.sum("total_kwh").alias("total_kwh"),
            F.sum("num_meters").alias("num_meters"),
        )
    )


# --- wire: array form ---------------------------------------------------------------


def _wire_metric(m: Column) -> Column:
    fields = [m[f].alias(f) for f in METRIC_FIELDS if not f.endswith("_reading")]
    times = [to_micros(m[f]).alias(f) for f in ("first_reading", "last_reading")]
    return F.struct(*fields, *times)


def to_kafka_rows(envelopes: DataFrame) -> DataFrame:
    """(key, value): the collector, and the envelope as JSON with times in microseconds."""
    body = F.struct(
        to_micros(F.col("window_start")).alias("window_start"),
        to_micros(F.col("window_end")).alias("window_end"),
        "shard_id",
        "collector_id",
        "total_count",
        F.transform(metric_array(envelopes), _wire_metric).alias("metrics"),
        *[c for c in ("part", "whole") if c in envelopes.columns],
    )
    return envelopes.select(
        F.col("collector_id").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
    )


def _read_metric(m: Column) -> Column:
    fields = [m[f].alias(f) for f in METRIC_FIELDS if not f.endswith("_reading")]
    times = [from_micros(m[f]).alias(f) for f in ("first_reading", "last_reading")]
    return F.struct(*fields, *times)


def with_decoded(rows: DataFrame) -> DataFrame:
    """Add the decoded array envelope as `envelope`; null where the value is malformed.

    Malformed is: no value, bytes that are not UTF-8, text that is not exactly one JSON object,
    or a field of the wrong type.
    """
    text = F.try_validate_utf8(F.col("value").cast("string"))
    return with_body(rows, text, ARRAY_ENVELOPE, "envelope")


def array_envelopes(decoded: DataFrame) -> DataFrame:
    """The sound envelopes as columns, after the columns that came with the message.

    A missing window end is the time of the message.
    """
    carried = [c for c in decoded.columns if c not in ("key", "value", "envelope")]
    e = F.col("envelope")
    end = from_micros(e["window_end"])
    if "timestamp" in carried:
        end = F.coalesce(end, F.col("timestamp"))
    return decoded.filter("envelope is not null").select(
        *carried,
        from_micros(e["window_start"]).alias("window_start"),
        end.alias("window_end"),
        e["shard_id"].alias("shard_id"),
        e["collector_id"].alias("collector_id"),
        e["total_count"].alias("total_count"),
        F.transform(e["metrics"], _read_metric).alias("metrics"),
        F.coalesce(e["part"], F.lit(0)).alias("part"),
        e["whole"].alias("whole"),
    )


def malformed(decoded: DataFrame) -> DataFrame:
    """The messages for the dead-letter table, as they came."""
    return decoded.filter("envelope is null").drop("envelope")


def parse_array_envelopes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound envelopes, malformed messages) of Kafka-shaped rows."""
    decoded = with_decoded(rows)
    return array_envelopes(decoded), malformed(decoded)


def _default_metric(m: Column) -> Column:
    given = {"count": F.lit(0).cast("bigint")}
    given |= {f: F.lit(0.0) for f in ("sum_kwh", "avg_voltage", "avg_current")}
    return F.struct(
        *[(F.coalesce(m[f], given[f]) if f in given else m[f]).alias(f) for f in METRIC_FIELDS]
    )


def apply_defaults(envelopes: DataFrame) -> DataFrame:
    """Fill what a producer left out.

    Minimum and maximum stay null: aggregates pass over them, as they would over the
    infinities that stand for "none yet".
    """
    named = F.coalesce("collector_id", F.lit(UNKNOWN_COLLECTOR))
    count = F.coalesce("total_count", F.lit(0).cast("bigint"))
    present = F.filter(metric_array(envelopes), lambda m: m.isNotNull())
    filled = F.transform(present, _default_metric)
    return envelopes.withColumns(
        {
            "collector_id": named,
            "total_count": count,
            "metrics": F.coalesce(filled, F.array().cast(T.ArrayType(METRIC))),
        }
    )


# --- wire: map form -----------------------------------------------------------------


def to_map_json(envelopes: DataFrame) -> DataFrame:
    """(value): the envelope as JSON with metrics keyed by meter and RFC 3339 times."""
    body = F.struct(*[f for f in MAP_ENVELOPE.fieldNames() if f in envelopes.columns])
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return envelopes.select(F.to_json(body, options).alias("value"))


def with_decoded_map(rows: DataFrame) -> DataFrame:
    """Add the decoded map envelope as `envelope`; null for malformed and empty bodies.

    An object without any known field is an empty body.
    """
    decoded = with_body(rows, F.col("value"), MAP_ENVELOPE, "envelope")
    given = [F.col(f"envelope.{f}").isNotNull() for f in MAP_ENVELOPE.fieldNames()]
    return decoded.withColumn("envelope", F.when(F.greatest(*given), F.col("envelope")))


def map_envelopes(decoded: DataFrame) -> DataFrame:
    """The sound envelopes as columns, after the columns that came with the body."""
    carried = [c for c in decoded.columns if c not in ("value", "envelope")]
    fields = [F.col(f"envelope.{f}").alias(f) for f in MAP_ENVELOPE.fieldNames() if f != "part"]
    part = F.coalesce(F.col("envelope.part"), F.lit(0)).alias("part")
    return decoded.filter("envelope is not null").select(*carried, *fields, part)


def parse_map_envelopes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound envelopes, rejected bodies) of rows (value, received_at)."""
    decoded = with_decoded_map(rows)
    return map_envelopes(decoded), malformed(decoded)
