"""Exact deduplication: frequent digests are settled on the map side, the others by a shuffle."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.session import written

#: Counters of a Misra-Gries summary. Every digest that has more than 2 / (COUNTERS + 1) of all
#: rows is found; the broadcast has at most so many rows.
COUNTERS = 1024


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes an empty text."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # only ASCII: lower() is exact and fast
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def reduced(counts: pa.Table, counters: int) -> pa.Table:
    """Misra-Gries: with too many keys, take the largest count left out from all of them."""
    if len(counts) <= counters:
        return counts
    order = pc.select_k_unstable(counts, counters + 1, [("n", "descending")])
    top = counts.take(order)
    least = top["n"][counters].as_py()
    top = top.set_column(1, "n", pc.subtract(top["n"], least))
    return top.filter(pc.greater(top["n"], 0))


def summaries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """One Misra-Gries summary of all batches of a partition; batches are merged one by one."""
    schema = pa.schema([("digest", pa.binary()), ("n", pa.int64())])
    held = schema.empty_table()
    for batch in batches:
        new = pc.value_counts(batch.column(0))
        new = pa.table([new.field(0), new.field(1)], schema=schema)
        held = pa.concat_tables([held, new]).group_by("digest").aggregate([("n", "sum")])
        held = reduced(held.rename_columns(["digest", "n"]), counters)
    yield from held.combine_chunks().to_batches()


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, among them all that have over 2 / (counters + 1) of the rows.

    Per partition a digest loses at most its partition's rows / (counters + 1), in all at most
    rows / (counters + 1). The summed counts are no more than the rows, so fewer than
    counters + 1 digests can keep more than that.
    """
    local = rows.select("digest").mapInArrow(
        lambda batches: summaries(batches, counters), "digest binary, n bigint"
    )
    merged = local.groupBy("digest").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def exact_groups(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of `docs`: its digest, the id that stays, the group's size, and `kept`.

    Texts are equal when they agree after lower-casing A-Z; null counts as empty. The row with
    the largest id stays; a null id is smaller than any other. Of repeated rows with the same
    id one stays. Columns: `row_id`, text_key (long, a hash of the text as it stands), keep_id,
    group_size, kept, digest (binary SHA-256). Other columns are not read. Empty in, empty out.
    """
    digest = F.unhex(F.sha2(ascii_lower(F.col(text)).cast("binary"), 256))
    rows = docs.select(
        F.col(row_id).alias("id"), F.xxhash64(text).alias("text_key"), digest.alias("digest")
    )
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "digests")

    winner = [
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("id", "at")).alias("winner"),
    ]
    often = frequent_digests(rows, counters)
    # Exact counts and winners of the candidates; a candidate that occurs once is no use.
    settled = rows.join(F.broadcast(often), "digest").groupBy("digest").agg(*winner)
    settled = written(settled.where("group_size > 1").limit(counters), "frequent-digests")

    seen = rows.join(F.broadcast(settled), "digest", "left")
    frequent = seen.where("group_size IS NOT NULL")
    rest = seen.where("group_size IS NULL").select("digest", "id", "text_key", "at")
    rest = rest.join(rest.groupBy("digest").agg(*winner), "digest")
    return frequent.unionByName(rest).select(
        F.col("id").alias(row_id),
        "text_key",
        F.col("winner.id").alias("keep_id"),
        "group_size",
        (F.col("at") == F.col("winner.at")).alias("kept"),
        "digest",
    )
