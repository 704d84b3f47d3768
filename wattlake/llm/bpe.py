"""Byte-pair encoding and decoding with an index from pairs to their positions."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.pretokens import (
    CACHED_CHARS, LETTERS, Cache, cut_special, pre_tokens, runs, special_strings, tokenizer_file,
)

#: Characters of text whose new pre-tokens are merged together: the index covers the distinct
#: pre-tokens of such a block of a partition, so its size is bounded.
BLOCK_CHARS = 4_000_000
#: From so many positions on, those of a rank are merged at once.
AT_ONCE = 24
#: Runs whose ids a worker remembers.
RUNS = 200_000
#: Bits of an id in a pair's key.
SHIFT = 20


class Merges:
    """The merge rules of a byte-level BPE file."""

    def __init__(self, path: str):
        model = tokenizer_file(path)["model"]
        vocab = model["vocab"]
        special = special_strings(path)
        of_letter = {letter: byte for byte, letter in enumerate(LETTERS)}
        self.first = np.array([vocab[letter] for letter in LETTERS], dtype=np.int64)  # by byte
        self.left, self.right, self.made = [], [], []
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = vocab[a], vocab[b]
            self.left.append(left)
            self.right.append(right)
            self.made.append(vocab[a + b])
            self.rank.setdefault(left << SHIFT | right, rank)
        #: No merge makes a pair of a lower rank, so a rank is done once it has been taken.
        source = {made: rank for rank, made in reversed(list(enumerate(self.made)))}
        self.steady = all(
            rank > max(source.get(a, -1), source.get(b, -1))
            for rank, (a, b) in enumerate(zip(self.left, self.right))
        )
        keys = np.fromiter(self.rank, dtype=np.int64, count=len(self.rank))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(self.rank.values(), dtype=np.int64, count=len(keys))[order]
        #: The bytes of each id, for decoding.
        self.bytes = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, number in vocab.items():
            self.bytes[number] = bytes(of_letter[x] for x in token)
        for token, number in special.items():
            self.bytes[number] = token.encode()

    def encode(self, tokens: list[str]) -> list[bytes]:
        """The ids of each pre-token, as little-endian unsigned 32-bit integers.

        All pre-tokens lie in one row of symbols. An index maps a rank, that is a pair, to the
        positions of its left symbols. Ranks are taken in ascending order; a merge moves the
        positions of the two pairs that it makes into their lists.
        """
        raw = [t.encode() for t in tokens]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ends = np.cumsum(size)
        start = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        if not len(start):
            return [b""] * len(tokens)
        row = Row(self, start, ends, size)
        row.merge()
        symbols = np.frombuffer(row.symbol, dtype=np.int64)
        live = symbols >= 0
        upto = 4 * np.concatenate([[0], np.cumsum(live)])[np.concatenate([[0], ends])]
        ids = symbols[live].astype("<u4").tobytes()
        bounds = upto.tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def ranks_of(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair's key, -1 for pairs that are never merged."""
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], -1)

    def decode(self, ids: bytes) -> str:
        """The text of ids as `encode` gives them; special ids give their strings."""
        numbers = np.frombuffer(ids, dtype="<u4").tolist()
        return b"".join([self.bytes[n] for n in numbers]).decode(errors="replace")


class Row:
    """A row of symbols, linked both ways, and the positions of its pairs by rank.

    The numbers lie in arrays that plain loops and numpy both see: a rank with few positions is
    merged one by one, a rank with many at once.
    """

    def __init__(self, merges: Merges, start: np.ndarray, ends: np.ndarray, size: np.ndarray):
        total = len(start)
        following = np.arange(1, total + 1)
        following[ends[size > 0] - 1] = -1
        before = np.arange(-1, total - 1)
        before[(ends - size)[size > 0]] = -1
        here = np.nonzero(following >= 0)[0]
        self.merges = merges
        self.symbol, self.following, self.before = (array("q", x.tobytes()) for x in (start, following, before))
        self.scratch = np.empty(total, dtype=np.int64)
        self.places: dict[int, list] = {}
        self.active: list[int] = []
        self.note(here, start[here] << SHIFT | start[here + 1])

    def note(self, positions: np.ndarray, pairs: np.ndarray) -> None:
        """Put positions into the lists of the pairs that now begin there."""
        rank = self.merges.ranks_of(pairs)
        known = rank >= 0
        positions, rank = positions[known], rank[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = (np.nonzero(rank[1:] != rank[:-1])[0] + 1).tolist()
        bounds = [0, *cuts, len(rank)]
        for r, a, b in zip(rank[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if r in self.places:
                self.places[r].append(positions[a:b])
            else:
                self.places[r] = [positions[a:b]]
                heappush(self.active, r)

    def merge(self) -> None:
        """All ranks in ascending order. A position whose symbols have changed is passed over."""
        while self.active:
            rank = heappop(self.active)
            parts = self.places.pop(rank, None)
            if parts is None:
                continue
            count = sum(1 if type(x) is int else len(x) for x in parts)
            if count >= AT_ONCE and self.merges.steady and self.merges.left[rank] != self.merges.right[rank]:
                self.merge_many(rank, np.concatenate([np.atleast_1d(x) for x in parts]))
            else:
                positions = []
                for x in parts:
                    positions.append(x) if type(x) is int else positions.extend(x.tolist())
                self.merge_few(rank, sorted(positions))

    def merge_many(self, rank: int, at: np.ndarray) -> None:
        """A pair of two unlike symbols cannot overlap itself, so all its positions merge at once."""
        symbol, following, before = (
            np.frombuffer(x, dtype=np.int64) for x in (self.symbol, self.following, self.before)
        )
        made = self.merges.made[rank]
        own = np.arange(len(at))
        self.scratch[at] = own  # of a position that is noted twice, the last note counts
        after = following[at]
        here = (self.scratch[at] == own) & (symbol[at] == self.merges.left[rank]) & (after >= 0)
        here &= symbol[after] == self.merges.right[rank]
        i, j = at[here], after[here]
        if not len(i):
            return
        k, h = following[j], before[i]
        symbol[i], symbol[j], following[i] = made, -1, k
        right = k >= 0
        before[k[right]] = i[right]
        left = h >= 0
        # A left neighbour may have become part of a merge itself: its own right side notes that.
        left[left] = symbol[h[left]] >= 0
        self.note(
            np.concatenate([i[right], h[left]]),
            np.concatenate([made << SHIFT | symbol[k[right]], symbol[h[left]] << SHIFT | made]),
        )

    def merge_few(self, rank: int, positions: list[int]) -> None:
        """One by one. Should a new pair have a lower rank, the work stops and goes on after it."""
        symbol, following, before = self.symbol, self.following, self.before
        places, active, rank_of = self.places, self.active, self.merges.rank.get
        left, right, made = self.merges.left[rank], self.merges.right[rank], self.merges.made[rank]
        for n, i in enumerate(positions):
            if symbol[i] != left:
                continue
            j = following[i]
            if j < 0 or symbol[j] != right:
                continue
            symbol[i], symbol[j] = made, -1
            k = following[i] = following[j]
            lowest = rank
            if k >= 0:
                before[k] = i
                new = rank_of(made << SHIFT | symbol[k])
                if new is not None:
                    if new in places:
                        places[new].append(i)
                    else:
                        places[new] = [i]
                        heappush(active, new)
                    lowest = min(lowest, new)
            h = before[i]
            if h >= 0:
                new = rank_of(symbol[h] << SHIFT | made)
                if new is not None:
                    if new in places:
                        places[new].append(h)
                    else:
                        places[new] = [h]
                        heappush(active, new)
                    lowest = min(lowest, new)
            if lowest < rank:
                if rank in places:
                    places[rank].extend(positions[n + 1 :])
                else:
                    places[rank] = positions[n + 1 :]
                    heappush(active, rank)
                return


class Encoder:
    """Encodes texts block by block; a worker keeps the ids of runs that it has seen."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.special = {x: n.to_bytes(4, "little") for x, n in special_strings(path).items()}
        self.spaced = Cache(None, RUNS)
        self.plain = Cache(None, RUNS // 8)

    def learn(self, wanted: set[str], spaced: bool, known: dict[str, bytes]) -> None:
        """Put the ids of runs into `known` and the cache."""
        held = self.spaced if spaced else self.plain
        new = [run for run in wanted if run not in held]
        known.update({run: held[run] for run in wanted if run in held})
        whole = [run for run in new if run.isalpha()]  # a pre-token each
        mixed = [run for run in new if not run.isalpha()]
        parts = [pre_tokens(run, spaced) for run in mixed]
        tokens = [" " + run for run in whole] if spaced else list(whole)
        distinct = list(dict.fromkeys(t for part in parts for t in part))
        ids = self.merges.encode(tokens + distinct)
        known.update(zip(whole, ids))
        of_token = dict(zip(distinct, ids[len(whole) :]))
        known.update(
            (run, of_token[part[0]] if len(part) == 1 else b"".join([of_token[t] for t in part]))
            for run, part in zip(mixed, parts)
        )
        room = held.entries - len(held)
        short = [run for run in new if len(run) <= CACHED_CHARS]
        if len(short) > room:
            for old in [k for k, _ in zip(held, range(held.entries // 2))]:
                del held[old]
        held.update((run, known[run]) for run in short[: held.entries // 2])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, equal to the library's without added begin and end tokens."""
        cut = [cut_special(text, self.special) for text in texts]
        split = [[(runs(x) if x else None, after) for x, after in parts] for parts in cut]
        first, rest = set(), set()
        for parts in split:
            for own, _ in parts:
                if own:
                    first.add(own[0])
                    rest.update(own[1:])
        starts: dict[str, bytes] = {}
        spaced: dict[str, bytes] = {}
        self.learn(first, False, starts)
        self.learn(rest, True, spaced)
        out = []
        for parts in split:
            ids = []
            for own, after in parts:
                if own:
                    ids.append(starts[own[0]])
                    ids.extend(map(spaced.__getitem__, own[1:]))
                if after is not None:
                    ids.append(after)
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each worker process, kept from task to task."""
    return Encoder(path)


def blocks(texts: list[str | None], chars: int = BLOCK_CHARS) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def encoded(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    own = encoder(path)
    for batch in batches:
        at = 0
        for block in blocks([x or "" for x in batch.column(1).to_pylist()]):
            ids = own.encode(block)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(block)), pa.array(ids, pa.binary())], schema=schema
            )
            at += len(block)


def encode_texts(docs: DataFrame, path: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: ids (binary, little-endian unsigned 32-bit integers).

    `path` is the file of a byte-level BPE tokenizer without a normalizer. The ids equal the
    library's; a special string inside a text becomes its id. Null counts as empty and has no
    ids. Row ids may be null or repeat. Other columns are not read. Empty in, empty out. Nothing
    is shuffled.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary())])
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(lambda batches: encoded(batches, path, schema), "id bigint, ids binary")
    return out.withColumnRenamed("id", row_id)


def decoded(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    merges = encoder(path).merges
    for batch in batches:
        texts = [merges.decode(x or b"") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], schema=schema
        )


def decode_ids(coded: DataFrame, path: str, row_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Add `decoded`, the text of the ids; columns `row_id`, ids, decoded. Null ids: empty text."""
    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
    rows = coded.select(F.col(row_id).cast("bigint").alias("id"), F.col(ids).alias("ids"))
    out = rows.mapInArrow(
        lambda batches: decoded(batches, path, schema), "id bigint, ids binary, decoded string"
    )
    return out.withColumnRenamed("id", row_id)


def round_trip(batches: Iterator[pa.RecordBatch], path: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Encode and decode block by block; of ids and texts only the digests leave the task."""
    own = encoder(path)
    for batch in batches:
        at = 0
        for block in blocks(batch.column(1).to_pylist()):
            ids = own.encode([x or "" for x in block])
            text = [sha256(own.merges.decode(x).encode()).hexdigest() for x in ids]
            columns = [[len(x) // 4 for x in ids], [sha256(x).hexdigest() for x in ids], text]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(block)), *arrays], schema=schema
            )
            at += len(block)


def round_trip_digests(docs: DataFrame, path: str, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`row_id`, n_tokens, ids_sha256 and decoded_sha256 of `encode_texts` and `decode_ids`.

    Both run in one Python worker, so that neither ids nor decoded texts are sent between.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(
        lambda batches: round_trip(batches, path, schema),
        "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
    return out.withColumnRenamed("id", row_id)
