"""Vector dedup whose probes leave lists out: links stay true, mutual, and nearly all found."""

from collections import Counter

import numpy as np
import pytest

from wattlake.llm import vectors

LEAST, LISTS = 0.93, 64


def planted(n: int, size: int = 64) -> np.ndarray:
    """Random unit vectors, each with a neighbour at a cosine just above LEAST."""
    rng = np.random.default_rng(23)
    x = rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    cosine = rng.uniform(LEAST + 1e-4, LEAST + 0.01, n)[:, None]
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * away]).astype(np.float32)


def test_margin_prunes_and_grows_with_the_share():
    x = planted(4000).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.fit_index(x, LISTS)
    margins = [index.margin(x, LEAST, share) for share in (0.9, 0.99, 1.0)]
    assert margins[0] < margins[1] < margins[2] == pytest.approx(np.sqrt(2 - 2 * LEAST))
    lists = vectors.nearest(x, index.centres)
    probes = index.probes(x, margins[1])
    found = np.mean([lists[(i + 4000) % 8000] in probes[i] for i in range(8000)])
    assert found >= 0.98 and np.mean([len(p) for p in probes]) < LISTS / 3
    assert all(lists[i] in probes[i] for i in range(8000))


def test_runs_do_not_change_distances(monkeypatch):
    x = planted(100).astype(float)
    index = vectors.fit_index(x, 16)
    whole = vectors.nearest(x, index.centres), [p.tolist() for p in index.probes(x, 0.2)]
    monkeypatch.setattr(vectors, "CELLS", 50)
    assert (vectors.nearest(x, index.centres) == whole[0]).all()
    assert [p.tolist() for p in index.probes(x, 0.2)] == whole[1]


@pytest.mark.parametrize("share", [0.99, 0.5])
def test_planted_links(spark, monkeypatch, share):
    monkeypatch.setattr(vectors, "LEAST_LISTS", LISTS)
    x = planted(1500)
    x = np.concatenate([x, x[:3]])
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    got = vectors.embedding_links(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), share=share).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    true = (unit @ unit.T >= LEAST) & ~np.eye(len(x), dtype=bool)
    n = {r.vec_id: r.n_links for r in got}
    assert len(n) == len(x) and all(n[i] <= true[i].sum() for i in n)
    assert sum(n.values()) >= (0.99 if share == 0.99 else 0.5) * true.sum()
    # A link counts for both of its vectors, and links what it counts.
    root = {r.vec_id: r.component_id for r in got}
    assert all(n[i] == n[i + 1500] for i in range(3, 1500))
    assert all((n[i] > 0) == (root[i] == root[i + 1500] == i) for i in range(3, 1500))
    size = Counter(root.values())
    assert all(size[root[i]] > 1 for i in n if n[i])


def test_few_and_many_pairs_have_the_same_links():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    all_near = np.ones((60, 60), dtype=bool)
    dense = vectors.cosines(x, x, all_near, 0.5)
    few = rng.random((60, 60)) < 0.04
    assert (vectors.cosines(x, x, few, 0.5) == (dense & few)).all()
    assert (dense == dense.T).all()
