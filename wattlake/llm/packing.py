"""Packing token sequences: shortest pack first over the histogram of lengths."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.pretokens import sliced
from wattlake.llm.ranks import even, ranked
from wattlake.llm.word_ids import word_ids
from wattlake.session import written

PIECE = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def cut(ids: bytes, size: int) -> list[tuple[int, int, int]]:
    """(start, length, checksum) of the pieces of at most `size` ids, four bytes each."""
    pieces = [(a, ids[4 * a : 4 * (a + size)]) for a in range(0, len(ids) // 4, size)]
    return [(a, len(x) // 4, zlib.crc32(x)) for a, x in pieces]


def pieces(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    own, end = word_ids(path), end_id.to_bytes(4, "little")
    for batch in sliced(batches):
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = own.ids(text) + end
            rows += [(doc, a, n, crc, len(ids) // 4) for a, n, crc in cut(ids, size)]
        columns = list(zip(*rows)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def token_pieces(docs: DataFrame, path: str, end_id: int, size: int, row_id: str, text: str) -> DataFrame:
    """Columns id, start, length, ids_crc32, doc_tokens: one row per piece of at most `size`."""
    names = [x.split(" ")[0] for x in PIECE.split(", ")]
    schema = pa.schema([(x, pa.int64()) for x in names])
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(lambda batches: pieces(batches, path, end_id, size, schema), PIECE)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first pack, offset): where the items of each length go.

    Lengths are placed longest first. Packs with the same contents are one pattern with a count,
    and their numbers are consecutive. The items of a length go to the packs that are shortest so
    far, if they fit there, else to new ones; a pattern that is used in part is split in two.
    The work hangs on the number of lengths and patterns, not on the counts.
    """
    placed = []
    open_packs: list[tuple[int, int, int]] = []  # (tokens so far, first pack, number), a heap
    packs = 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if open_packs and open_packs[0][0] + length <= size:
                used, first, number = heapq.heappop(open_packs)
                taken = min(number, left)
                if taken < number:
                    heapq.heappush(open_packs, (used, first + taken, number - taken))
            else:
                used, first, taken = 0, packs, left
                packs += taken
            placed.append((length, rank, taken, first, used))
            if used + length < size:
                heapq.heappush(open_packs, (used + length, first, taken))
            rank, left = rank + taken, left - taken
    return placed


def placed(
    batches: Iterator[pa.RecordBatch], slots: np.ndarray, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Look (length, rank) up among the slots; both are joined to one number that sorts alike."""
    starts = slots[:, 0] << 40 | slots[:, 1]
    order = np.argsort(starts)
    slots, starts = slots[order], starts[order]
    for batch in batches:
        at = {n: batch.column(n) for n in batch.schema.names}
        length, rank = at["length"].to_numpy(), at["_rank"].to_numpy()
        slot = slots[np.searchsorted(starts, length << 40 | rank, side="right") - 1]
        sequence = slot[:, 3] + (rank - slot[:, 1])
        columns = [*[at[n] for n in schema.names[:-2]], pa.array(sequence), pa.array(slot[:, 4])]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    size: int = 2048,
    row_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pack the ids of all texts, each closed by `end_id`, into sequences of at most `size`.

    A document is cut every `size` ids; each id lies in one piece, each piece in one sequence.
    Returns one row per piece: `row_id`, start (ids of the document before it), length,
    ids_crc32, doc_tokens, sequence_id (from 0, no gaps), offset (in the sequence, no gaps).
    A null or empty text has the one id `end_id`. Repeated rows are packed each. Row ids may be
    null. Other columns are not read. Empty in, empty out.

    The driver gets the histogram, at most `size` rows; the slots made from it hang on the
    lengths, not on the number of documents. Pieces find their slot by their rank among the
    pieces of the same length.
    """
    made = token_pieces(docs, path, end_id, size, row_id, text)
    lot = even(F.concat_ws("|", "id", "start", "ids_crc32"))
    made = written(made.withColumn("_lot", lot), "pieces")
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = np.array(shortest_pack_first(histogram, size), dtype=np.int64).reshape(-1, 5)
    sent = docs.sparkSession.sparkContext.broadcast(slots)

    order = ["id", "start", "ids_crc32", "doc_tokens"]
    numbered = ranked(made, ["length"], "_lot", order, "_rank", "_of_length")
    numbered = numbered.select(*[x.split(" ")[0] for x in PIECE.split(", ")], "_rank")
    names = [*numbered.columns[:-1], "sequence_id", "offset"]
    schema = pa.schema([(x, pa.int64()) for x in names])
    out = numbered.mapInArrow(
        lambda batches: placed(batches, sent.value, schema),
        PIECE + ", sequence_id bigint, offset bigint",
    )
    return out.withColumnRenamed("id", row_id)
