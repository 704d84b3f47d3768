import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest_llm import ODD
from pyspark.sql import types as T

from wattlake.llm import components, neardup, shingles, vectors
from wattlake.llm.survivors import surviving


def shingle_sets(texts):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def groups(ids, linked):
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                root[find(a)] = find(b)
    members = {}
    for a in range(len(ids)):
        members.setdefault(find(a), []).append(ids[a])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    return [least[find(a)] for a in range(len(ids))], len(members)


def near_expected(rows):
    sets = shingle_sets([t for _, t, _ in rows])

    def linked(a, b):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        return either and 100 * both >= 75 * either

    least, number = groups([i for i, _, _ in rows], linked)
    return Counter(zip([i for i, _, _ in rows], map(len, sets), least)), number


def near_cases(seed=5):
    """Texts with chains of edits, a large family of near copies, and shared passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows, family = [], [word() for _ in range(120)]
    for i in range(80):
        own = list(family)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = word()
        rows.append((i, " ".join(own), "s"))
    for i in range(80, 140):
        rows.append((i, " ".join([word() for _ in range(rng.randint(20, 200))] + passage), "s"))
    chain = [word() for _ in range(60)]
    for i in range(140, 160):
        chain[rng.randrange(60)] = word()
        rows.append((i, " ".join(chain).upper(), "s"))
    return rows + [(i, "x y z", "s") for i in range(200, 204)]


@pytest.mark.parametrize("paired,block", [(32, 8_000_000), (3, 4_000)])
def test_near_groups(docs_of, monkeypatch, paired, block):
    monkeypatch.setattr(neardup, "PAIRED", paired)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", block)
    rows = near_cases()
    got = neardup.near_groups(docs_of(rows)).collect()
    want, number = near_expected(rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sum(r.stays for r in got) == number


def test_near_groups_of_odd_rows(odd, none):
    got = neardup.near_groups(odd).collect()
    want, number = near_expected(ODD)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.stays for r in got) == number
    left = surviving(odd, neardup.near_groups(odd).where("stays"), "doc_id", "text")
    assert left.columns == odd.columns and left.count() == number
    assert neardup.near_groups(none).count() == 0


def test_keys_meet_within_the_distance():
    rng = np.random.default_rng(7)
    for _ in range(50):
        a = rng.integers(0, 1 << 16, shingles.POSITIONS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(shingles.POSITIONS, neardup.DISTANCE, replace=False)] += 1
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([a.tobytes(), b.tobytes()])], names=["node", "sketch"])
        out = next(neardup.keyed(iter([batch])))
        keys = [{k for k, n in zip(*(c.to_pylist() for c in out.columns)) if n == node} for node in (0, 1)]
        assert keys[0] & keys[1] and len(keys[0]) == 40


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 90)).astype(np.uint64)) for _ in range(25)]
    got = neardup.shared_counts(sets[:10], sets[10:])
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[10 + j])) for i in range(10) for j in range(15))
    assert shingles.common(sets[0], sets[1]) == len(np.intersect1d(sets[0], sets[1]))


def test_connected(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {a: find(a) for a in list(root)}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(x, T.StringType()) for x in ("at", "unit", "node", "list")],
    ]
)


def vector_expected(rows, least):
    unit = []
    for _, v, label in rows:
        good = label is not None and v and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v)
        x = np.zeros(16)
        if good:
            x[: len(v)] = np.array(v, dtype=np.float32)
        unit.append(x / np.linalg.norm(x) if good else None)

    def linked(a, b):
        return (
            unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and float(unit[a] @ unit[b]) >= least
        )

    n = [sum(linked(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    component, _ = groups([i for i, _, _ in rows], linked)
    return Counter(zip([i for i, _, _ in rows], n, component))


@pytest.mark.parametrize("block", [2048, 16])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(11)
    heads = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        x = heads[0 if i % 3 == 0 else i % 12] + 0.12 * rng.normal(size=16)
        rows.append((i, x.astype(np.float32).tolist(), i % 2))
    rows += [(300 + k, rows[0][1], 0) for k in range(5)] + [(302, rows[0][1], 0), (310, [2 * x for x in rows[0][1]], 0)]
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0], [1.0] + [0.0] * 15]
    rows += [(400 + k, v, 1) for k, v in enumerate(odd)] + [(500, rows[0][1], None), (None, None, None)]
    frame = spark.createDataFrame([(*r, *["other"] * 4) for r in rows], VECTORS).repartition(3)
    got = vectors.embedding_links(frame).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == vector_expected(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_links_of_nothing(spark):
    assert vectors.embedding_links(spark.createDataFrame([], VECTORS)).count() == 0
    some = spark.createDataFrame([(1, None, 3, *["x"] * 4)], VECTORS)
    assert [tuple(r) for r in vectors.embedding_links(some).collect()] == [(1, 0, 1, True)]


def test_probes_and_codes_lose_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.fit_index(x[:700], 24)
    lists, codes, error = index.encode(x)
    within = np.sqrt(2 - 2 * 0.9)
    probes = index.probes(x, within)
    for a in range(0, 1500, 50):
        for b in np.nonzero(x @ x[a] >= 0.9)[0]:
            assert lists[b] in probes[a]
            far = index.distances(x[a : a + 1], lists[b], codes[b : b + 1])[0, 0]
            assert np.sqrt(far) <= within + error[b] + 1e-3
    assert np.mean([len(p) for p in probes]) < 20
