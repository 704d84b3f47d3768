"""A corpus from raw documents: without toxic ones, copies and near copies, packed into sequences.

`STAGES` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return rows of `docs` with its columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import exact, neardup, packing, toxicity
from wattlake.llm.survivors import fresh, surviving
from wattlake.llm.workers import reachable
from wattlake.session import written

#: Words of packed sequences come from this tokenizer; documents end with this id.
TOKENIZER, END_ID, SEQUENCE = "word_bpe_49k.json", 1, 2048


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; the classifier learns from `labels`."""
    reachable(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = fresh(docs, "toxicity")
    scored = toxicity.score(docs, model, name=name)
    return scored.where(F.col(name)["score"] < 0.5).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    reachable(spark)
    return surviving(docs, exact.exact_groups(docs).where("kept"), "doc_id", "text")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect the one with the smallest doc_id."""
    reachable(spark)
    return surviving(docs, neardup.near_groups(docs).where("stays"), "doc_id", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    reachable(spark)
    path = public_tokenizers.path(TOKENIZER)
    return packing.pack_documents(docs, path, end_id=END_ID, size=SEQUENCE)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

#: Neither the classifier nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
