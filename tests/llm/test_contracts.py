"""The registered queries: columns, types and rows of their contracts, and what op10 may learn from."""

from zlib import crc32

import pytest
from pyspark.sql import functions as F

from wattlake.llm import catalog

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op2_interleaved_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op4_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op6_bpe_round_trip": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op7_chat_format": (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    ),
    "op8_packing": (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    ),
    "op9_vector_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op11_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12_centroids": (
        "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    ),
    "op13_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    got = catalog.queries()[name](spark, SF)
    types = dict(got.dtypes)
    wanted = dict(x.split(" ") for x in COLUMNS[name].split(", "))
    assert {c: types.get(c) for c in wanted} == wanted
    if "doc_id" in wanted and name != "op8_packing":
        ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
        assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in ids.collect())


@pytest.fixture(scope="module")
def toxic_tables(spark, tmp_path_factory):
    """The given tables, and the same with every label of fold 0 turned round and other ids of language."""
    folder = str(tmp_path_factory.mktemp("toxic"))
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))).write.parquet(f"{folder}/labels.parquet")
    documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("one")).write.parquet(f"{folder}/documents.parquet")
    return "/root/testdata/sf0.01", folder


def test_toxicity_query(spark, toxic_tables):
    given, turned = ({r.doc_id: r for r in catalog.op10_toxicity(spark, t).collect()} for t in toxic_tables)
    assert len(given) == spark.read.parquet(f"{toxic_tables[0]}/documents.parquet").count()
    for i, row in given.items():
        assert row.held_out == (crc32(str(i).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        # Labels of fold 0, languages and sources say nothing to any score.
        assert turned[i].score == pytest.approx(row.score, abs=1e-9)
    labels = spark.read.parquet(f"{toxic_tables[0]}/labels.parquet").where("toxic IS NOT NULL").collect()
    held = [(given[r.doc_id].predicted, r.toxic) for r in labels if given[r.doc_id].held_out]
    toxic, clean = [p for p, t in held if t], [p for p, t in held if not t]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.1 * len(clean)
