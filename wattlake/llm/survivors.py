"""Apply the decisions of an operator to the rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that `docs` doesn't have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def surviving(docs: DataFrame, kept: DataFrame, row_id: str, text: str) -> DataFrame:
    """The rows of `docs` that `kept` names by (`row_id`, text_key), one row for each name.

    text_key is xxhash64 of the text as it stands, so that rows which share an id but not a
    text are told apart, and of repeated rows one stays. All columns of `docs` come back. The
    texts are shuffled once: the join's key is also what repeated rows are grouped by.
    """
    key, text_key, copy = (fresh(docs, x) for x in ("_row_key", "_text_key", "_copy"))
    names = kept.select(F.col(row_id).alias("_id"), F.col("text_key").alias("_key")).select(
        F.xxhash64("_id", "_key").alias("_names_key"), "_id", "_key"
    )
    rows = docs.withColumn(text_key, F.xxhash64(text)).withColumn(key, F.xxhash64(row_id, text_key))
    same = (
        (rows[key] == names["_names_key"])
        & (rows[text_key] == names["_key"])
        & rows[row_id].eqNullSafe(names["_id"])
    )
    once = W.Window.partitionBy(key, row_id, text_key).orderBy(key)
    return (
        rows.join(names, same, "left_semi")
        .withColumn(copy, F.row_number().over(once))
        .where(F.col(copy) == 1)
        .select(*docs.columns)
    )
