"""Blocks of large buckets are compared in strips."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from wattlake.llm import neardup


def table(sides):
    rows = [(k, node, np.array(sorted(s), dtype=np.uint64).tobytes()) for k, side in enumerate(sides) for node, s in side]
    side, node, members = zip(*rows)
    types = (pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip((side, node, members), types)], names=["side", "node", "members"])


def components(nodes, edges):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def made(rng, first, count):
    """Sets of 8 to 11 out of the 12 numbers of a family."""
    sets = []
    for node in range(first, first + count):
        family, size = rng.integers(count // 3), rng.integers(8, 12)
        sets.append((node, {100 * int(family) + int(x) for x in rng.choice(12, size, replace=False)}))
    return sets


@pytest.mark.parametrize("pairs", [1, 70, 10**6])
@pytest.mark.parametrize("itself", [False, True])
def test_strips_connect_what_links_connect(pairs, itself, monkeypatch):
    monkeypatch.setattr(neardup, "PAIRS", pairs, raising=False)
    rng = np.random.default_rng(5)
    one = made(rng, 1000, 40)
    # The smaller nodes are on the side that isn't cut into strips.
    two = one if itself else made(rng, 0, 35)
    links = [(a, b) for a, s in one for b, t in two if a != b and 100 * len(s & t) >= 75 * len(s | t)]
    nodes = {n for n, _ in one + two}
    got = neardup.block_edges(table([one, two])).to_pydict()
    assert links and components(nodes, zip(got["a"], got["b"])) == components(nodes, links)


def test_memory_of_many_small_sets_is_bounded():
    one = [(i, {i, i + 1, i + 2}) for i in range(3000)]
    both = table([one, one])
    tracemalloc.start()
    neardup.block_edges(both)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000
