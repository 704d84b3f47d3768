"""Token counts: a broadcast table of frequent pre-tokens, and caches in the workers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.pretokens import (
    CACHED_CHARS, Cache, as_letters, cut_special, pre_tokens, runs, sliced, special_strings, tokenizer,
)

#: Rows from which the frequent pre-tokens are taken, and the entries of the table. Both only set
#: how often a worker must encode a pre-token itself; no count hangs on them. An entry has at
#: most CACHED_CHARS characters, so the broadcast stays under about 4 MB.
SAMPLE_ROWS = 20_000
TABLE_ENTRIES = 32_768


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The TABLE_ENTRIES most frequent pre-tokens of a partition."""
    seen: Counter[str] = Counter()
    for batch in sliced(batches):
        for text in batch.column(0).to_pylist():
            first, *rest = runs(text or "")
            seen.update(pre_tokens(first, False))
            for run in rest:
                seen.update(pre_tokens(run, True))
        if len(seen) > 8 * TABLE_ENTRIES:
            seen = Counter(dict(seen.most_common(2 * TABLE_ENTRIES)))
    top = [(t, n) for t, n in seen.most_common(TABLE_ENTRIES) if len(t) <= CACHED_CHARS and n > 1]
    yield pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
        names=["token", "n"],
    )


def frequent_lengths(docs: DataFrame, text: str, path: str) -> dict[str, int]:
    """Pre-token -> its number of tokens, for the most frequent of a sample of the rows."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    some = docs.select(F.col(text).alias("text"))
    some = some.sample(share, seed=1) if share < 1 else some
    top = some.mapInArrow(frequent, "token string, n bigint").groupBy("token")
    top = top.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(TABLE_ENTRIES)
    model = tokenizer(path).model
    return {r.token: len(model.tokenize(as_letters(r.token))) for r in top.select("token").collect()}


class RunLengths:
    """Numbers of tokens of runs: known runs, then the frequent pre-tokens, then the tokenizer."""

    def __init__(self, path: str, table: dict[str, int]):
        self.table, self.model = table, tokenizer(path).model
        self.tokens = Cache(lambda t: len(self.model.tokenize(as_letters(t))))
        self.spaced = Cache(lambda run: sum(map(self.token, pre_tokens(run, True))))
        self.special = special_strings(path)

    def token(self, token: str) -> int:
        return self.table.get(token) or self.tokens[token]

    def plain(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = runs(text)
        start = sum(map(self.token, pre_tokens(first, False)))
        return start + sum(map(self.spaced.__getitem__, rest))

    def count(self, text: str | None) -> int:
        parts = cut_special(text or "", self.special)
        return sum(map(self.plain, [x for x, _ in parts])) + len(parts) - 1


#: The worker's lengths, kept from task to task while the table is the same.
HELD: dict[tuple, RunLengths] = {}


def worker_lengths(path: str, table: Broadcast) -> RunLengths:
    key = (path, len(table.value), hash(frozenset(table.value.items())))
    if key not in HELD:
        HELD.clear()
        HELD[key] = RunLengths(path, table.value)
    return HELD[key]


def counted(
    batches: Iterator[pa.RecordBatch], path: str, table: Broadcast, limit: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    lengths = worker_lengths(path, table)
    for batch in sliced(batches):
        texts = batch.column(1).to_pylist()
        tokens = [lengths.count(x) for x in texts]
        size = [len((x or "").encode()) for x in texts]
        columns = [size, tokens, [n > limit for n in tokens]]
        arrays = [batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: n_bytes (UTF-8), n_tokens, over_limit (more than `limit`).

    `path` is the file of a byte-level BPE tokenizer without a normalizer. Counts equal the
    library's without begin and end tokens; special strings in a text count as one token each.
    Null counts as empty: no bytes, no tokens. Ids may be null or repeat. Other columns are not
    read. Empty in, empty out. Nothing is shuffled but the candidates of the table.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, path))
    schema = pa.schema(
        [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(
        lambda batches: counted(batches, path, table, limit, schema),
        "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
    return out.withColumnRenamed("id", row_id)
