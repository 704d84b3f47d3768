"""A bidirectional FM-index over the word ids of a shard. Used inside Spark's workers.

The index serves phrases of up to DEPTH words, so it needs suffixes in order of their first DEPTH
words only: rows that agree in those lie in the same intervals, whatever their order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: The longest phrase that an index can count.
DEPTH = 4
#: The id that ends a piece. No phrase holds it.
END = 0


def by_context(ids: np.ndarray) -> np.ndarray:
    """The positions of `ids` in order of the DEPTH ids that follow from each; END follows the last."""
    rank = ids
    width = 1
    while True:
        after = np.full(len(rank), 0, dtype=np.int64)
        after[:-width] = rank[width:]
        pair = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.argsort(pair)
        width *= 2
        if width >= DEPTH:
            return order
        pair = pair[order]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(pair[1:] != pair[:-1])])


class Direction:
    """The Burrows-Wheeler transform of one reading direction, with the ranks of its symbols."""

    def __init__(self, ids: np.ndarray):
        order = by_context(ids)
        self.symbol = ids[order - 1]  # the id before each suffix; before the first it is END
        #: How often the row's symbol occurs in the rows above.
        self.above = np.empty(len(ids), dtype=np.int64)
        by_symbol = np.argsort(self.symbol, kind="stable")
        first = np.concatenate([[0], np.cumsum(np.bincount(ids))])
        self.above[by_symbol] = np.arange(len(ids)) - first[self.symbol[by_symbol]]


@dataclass
class Phrases:
    """Distinct phrases of one length: their words, and their intervals in both directions."""

    words: np.ndarray  # a row of ids for each phrase
    low: np.ndarray  # first row in the index of the text
    reversed_low: np.ndarray  # first row in the index of the reversed text
    count: np.ndarray  # rows of both intervals

    def where(self, kept: np.ndarray) -> Phrases:
        return Phrases(self.words[kept], self.low[kept], self.reversed_low[kept], self.count[kept])


class PhraseIndex:
    """Counts of phrases in `ids`, a sequence of word ids in which END closes every piece."""

    def __init__(self, ids: np.ndarray):
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids) or ids[-1] != END:
            ids = np.append(ids, END)
        self.sizes = np.bincount(ids)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.ids = ids

    @cached_property
    def text(self) -> Direction:
        return Direction(self.ids)

    @cached_property
    def reversed(self) -> Direction:
        """Of the reversed text; its END is last again, and so precedes its first suffix."""
        return Direction(np.concatenate([self.ids[:-1][::-1], [END]]))

    def single(self) -> Phrases:
        """All words."""
        words = np.nonzero(self.sizes)[0]
        words = words[words != END]
        low = self.first[words]
        return Phrases(words[:, None], low, low, self.sizes[words])

    def extensions(self, phrases: Phrases, left: bool) -> tuple[np.ndarray, Phrases]:
        """Every phrase with every word that occurs before (`left`) or after it.

        Also the row of `phrases` that each of them extends.
        """
        side = self.text if left else self.reversed
        own, other = (phrases.low, phrases.reversed_low) if left else (phrases.reversed_low, phrases.low)
        count = phrases.count
        source = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(source)) + np.repeat(own - np.cumsum(count) + count, count)
        symbol = side.symbol[rows]
        key = source * len(self.sizes) + symbol
        order = np.argsort(key, kind="stable")
        key = key[order]
        heads = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else order
        head_rows = order[heads]
        source, word = source[head_rows], symbol[head_rows]
        sizes = np.diff(np.append(heads, len(key)))
        # Below the interval of a phrase in the other direction lie its smaller extensions.
        before_source = np.cumsum(count) - count
        smaller = heads - before_source[source]
        new_own = self.first[word] + side.above[rows[head_rows]]
        new_other = other[source] + smaller
        words = phrases.words[source]
        pieces = [word[:, None], words] if left else [words, word[:, None]]
        low, reversed_low = (new_own, new_other) if left else (new_other, new_own)
        found = Phrases(np.concatenate(pieces, axis=1), low, reversed_low, sizes)
        real = word != END
        return source[real], found.where(real)
