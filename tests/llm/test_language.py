"""Language identification: gradients, windows, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest
from llm.conftest_llm import LONG
from pyspark.sql import functions as F

from wattlake.llm import byte_network, catalog, language_id
from wattlake.llm.byte_network import PAD, STRIDE, WINDOW, ByteNetwork, windows_of

TABLES = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = ByteNetwork(3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    symbols = rng.integers(0, PAD, (4, 20)).astype(np.int16)
    symbols[1, 12:] = PAD
    labels = np.array([0, 2, 1, 2])

    def loss():
        return -np.log(net.probabilities(symbols)[np.arange(4), labels]).mean()

    found = net.gradients(symbols, labels)
    for name, weight in net.weights.items():
        flat = weight.reshape(-1)
        steep = np.argsort(-np.abs(found[name].reshape(-1)))[:4]
        for at in steep:
            old, step = flat[at], 1e-6
            flat[at] = old + step
            up = loss()
            flat[at] = old - step
            down = loss()
            flat[at] = old
            assert found[name].reshape(-1)[at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-6)


@pytest.mark.parametrize("size", [0, 1, WINDOW - 1, WINDOW, WINDOW + 1, WINDOW + STRIDE, 5000])
def test_windows_cover_the_text(size):
    data = bytes(random.Random(size).randrange(256) for _ in range(size))
    rows = windows_of(data)
    assert rows.shape[1] == WINDOW
    seen = set()
    for n, row in enumerate(rows):
        for k, symbol in enumerate(row.tolist()):
            at = n * STRIDE + k
            assert symbol == (data[at] if at < size else PAD)
            seen.add(at)
    assert seen >= set(range(size)) and len(rows) <= max(1, size // STRIDE + 1)


def test_blocks_keep_every_window():
    texts = [b"a" * n for n in (0, 10, 3000, 100_000, 5)]
    blocks = list(byte_network.in_blocks(texts, windows=16))
    assert all(len(symbols) <= 32 for symbols, _ in blocks)
    owners = np.concatenate([o for _, o in blocks])
    assert np.bincount(owners).tolist() == [len(windows_of(t)) for t in texts]


@pytest.fixture(scope="module")
def model(spark):
    from wattlake.llm.workers import reachable

    reachable(spark)
    return language_id.fit(spark.read.parquet(f"{TABLES}/documents.parquet"))


def test_held_out_accuracy_and_columns(spark, model):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    got = catalog.op13_language_id(spark, TABLES)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    rows = {r.doc_id: r for r in got.collect()}
    truth = {r.doc_id: r for r in docs.select("doc_id", "lang", "text").collect()}
    assert rows.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r.score <= 1 for r in rows.values())
    held = [i for i, r in rows.items() if r.held_out and truth[i].lang is not None]
    assert np.mean([rows[i].lang_pred == truth[i].lang for i in held]) >= 0.98


def test_odd_rows(odd, model):
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(odd, model).collect()}
    unknown = {i for i, lang, score in got if lang == "und"}
    assert unknown == {3, 4, 5, None} and all(score == 0 for _, lang, score in got if lang == "und")
    assert language_id.identify(odd, model).count() == odd.count()
    long = {lang for i, lang, _ in got if i in (6, 7)}
    assert len(LONG) > 500_000 and len(long) == 1


def test_empty_and_nothing_to_learn(spark, none, odd, model):
    assert language_id.identify(none, model).count() == 0
    empty = language_id.fit(odd.withColumn("lang", F.lit(None).cast("string")))
    got = language_id.identify(odd, empty)
    assert {(r.lang_pred, r.score) for r in got.collect()} == {("und", 0.0)} and got.count() == odd.count()
    one = language_id.fit(odd.withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in language_id.identify(odd, one).collect()} == {"xx", "und"}


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(i, "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "seen", f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    assert language_id.fit(docs).languages == ["seen"]


def test_training_pieces_are_balanced_and_bounded(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 20 == 0, "b").otherwise("a").alias("lang"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text")
    )
    found = language_id.training_pieces(rows, each=100, most=150).groupBy("lang").count().collect()
    counts = {r.lang: r["count"] for r in found}
    assert sum(counts.values()) <= 150 and all(40 <= n <= 115 for n in counts.values())
