"""Sharding by proportional stratified interleaving, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.ranks import even, ranked
from wattlake.session import written


def stratum(source: Column) -> Column:
    """The source as a key without nulls: rows without a source are a stratum of their own."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))


def interleaved(
    rows: DataFrame, row_id: str, source: str, shards: int, seed: str, ties: list[str]
) -> DataFrame:
    """Add `shard` and `slot`: every shard holds the sources in the proportions of the whole.

    Rows are shuffled within their source by a seeded hash of `row_id` and ranked. The rank
    over the size of the source, shifted by an offset that hangs on the source alone, is a
    fraction in [0, 1). All rows are sorted by it and cut into `shards` runs of equal length.
    So the counts of shards differ by at most one, and the count of a source in a shard differs
    from its share by less than two. The offset spreads sources that have few rows.

    Slots count from 0 without gaps. Rows that agree in `row_id` and `ties` are interchangeable.
    A null id is hashed as an empty text; an empty table stays empty.
    """
    lot = rows.withColumn("_stratum", stratum(F.col(source))).withColumn(
        "_lot", even(F.concat_ws("|", F.lit(seed), F.col(row_id).cast("string")))
    )
    lot = written(lot, "shard-lots")
    drawn = ranked(lot, ["_stratum"], "_lot", [row_id, *ties], "_rank", "_of_source")
    shift = even(F.concat_ws("|", F.lit(seed), F.col("_stratum")))
    fraction = (F.col("_rank") + shift) / F.col("_of_source")
    mixed = written(drawn.withColumn("_fraction", fraction), "shard-mix")
    placed = ranked(mixed, [], "_fraction", ["_stratum", row_id, *ties], "_place", "_total")
    shard = F.floor(F.col("_place") * shards / F.col("_total")).cast("int")
    # The division is of doubles; the first place of a shard is taken from whole numbers.
    first = lambda k: F.expr(f"({k} * _total + {shards} - 1) div {shards}")
    placed = placed.withColumn("shard", shard)
    placed = placed.withColumn(
        "shard",
        F.when(F.col("_place") < first("shard"), F.col("shard") - 1)
        .when(F.col("_place") >= first("(shard + 1)"), F.col("shard") + 1)
        .otherwise(F.col("shard")),
    )
    placed = placed.withColumn("slot", F.col("_place") - first("shard"))
    return placed.drop("_stratum", "_lot", "_rank", "_of_source", "_fraction", "_place", "_total")


def shard_documents(docs: DataFrame, shards: int = 8, seed: str = "mix-1") -> DataFrame:
    """Shards of `docs` (doc_id, text, source) under the law `rows`.

    A null text has size 1 and the checksum of an empty text. Other columns of `docs` are not
    read. Repeated rows get a slot each.
    """
    narrow = docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = interleaved(narrow, "doc_id", "source", shards, seed, ["size", "text_crc32"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
