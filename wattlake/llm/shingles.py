"""Sets of word shingles and their minhash signatures. Used inside Spark's workers."""

from __future__ import annotations

import numpy as np
import xxhash

from wattlake.llm.pretokens import Cache

WORDS = 5
#: Positions of a signature, and the bits that are kept of each minimum.
POSITIONS, BITS = 40, 16
#: Shingles whose minima are taken in one step.
STEP = 16_384

_rng = np.random.default_rng(20240501)
#: Odd multipliers: one for each word of a shingle, one for each position of a signature.
PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPREAD = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


WORD_HASH = Cache(xxhash.xxh3_64_intdigest)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the 5-word shingles of a text.

    Words are what lies between ASCII white space, A-Z in lower case. With fewer than five words
    the whole sequence is the one shingle; without words the set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(WORD_HASH.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(WORDS, len(h))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total += h[k : len(h) - size + 1 + k] * PLACE[k]
    return np.unique(mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of POSITIONS numbers of BITS bits, from the minima of as many hashes; sets not empty."""
    out = np.empty((len(sets), POSITIONS), dtype=np.uint16)
    start = 0
    while start < len(sets):
        end, size = start, 0
        while end < len(sets) and (size == 0 or size + len(sets[end]) <= STEP):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[start:end])
        firsts = np.cumsum([0, *map(len, sets[start : end - 1])])
        for k in range(POSITIONS):
            least = np.minimum.reduceat((flat ^ SHIFT[k]) * SPREAD[k], firsts)
            out[start:end, k] = mixed(least) >> np.uint64(64 - BITS)
        start = end
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(a) else 0
