"""MinHash near-dedup: a multi-index Hamming join of b-bit signatures, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.components import block_roots, connected
from wattlake.llm.pretokens import sliced
from wattlake.llm.shingles import BITS, POSITIONS, common, shingle_set, signatures
from wattlake.session import written

#: Chunks of a signature. Two signatures that differ in at most DISTANCE positions have a chunk
#: that differs in at most DISTANCE // CHUNKS = 1 of its positions; that one is enumerated.
CHUNKS, DISTANCE = 10, 19
WIDTH = POSITIONS // CHUNKS
#: Positions in which signatures must agree before the sets are compared. Sets with a similarity
#: of 0.75 agree in 30 of 40 on average; they agree in fewer than 18 once in some 60,000 pairs.
AGREE = 18
#: Members of a bucket that are paired one by one. Larger buckets are compared block by block.
PAIRED = 32
#: Bytes of sets in a block, and its rows where the sets are small.
BLOCK_BYTES, BLOCK_ROWS = 8_000_000, 16_384
#: A key with more than this part of all rows is hot. So there are fewer hot keys than PARTS.
PARTS = 1024
#: Cells of the incidence matrices, and pairs of sets, that a block works on at once.
CELLS, PAIRS = 8_000_000, 2_000_000


# Sets and signatures -----------------------------------------------------------------------------

SKETCH = "at bigint, id bigint, text_key bigint, n bigint, class binary, sketch binary"


def sketched(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Size, digest and signature of the shingle set of each text; none for empty sets."""
    for batch in sliced(batches):
        sets = [shingle_set(x) for x in batch.column(3).to_pylist()]
        full = [s for s in sets if len(s)]
        rows = iter(signatures(full)) if full else iter(())
        size = [len(s) for s in sets]
        digest = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        sketch = [next(rows).tobytes() if len(s) else None for s in sets]
        columns = [*(batch.column(k) for k in range(3)), pa.array(size, pa.int64())]
        columns += [pa.array(digest, pa.binary()), pa.array(sketch, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each signature: for each chunk, all but one of its positions, at their place.

    Equal keys mean: this chunk differs in at most the position that is left out. A key holds
    the chunk, the position, and three numbers of 16 bits; different parts never share a key.
    """
    for batch in batches:
        sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16)
        sketch = sketch.reshape(-1, CHUNKS, WIDTH).astype(np.int64)
        keys = np.empty((len(sketch), CHUNKS, WIDTH), dtype=np.int64)
        for left_out in range(WIDTH):
            key = np.arange(CHUNKS)[None] * WIDTH + left_out
            for k in (k for k in range(WIDTH) if k != left_out):
                key = key << BITS | sketch[:, :, k]
            keys[:, :, left_out] = key
        node = np.repeat(batch.column(0).to_numpy(), CHUNKS * WIDTH)
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(node)], names=["key", "node"])


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, members): the sets of texts again, as sorted 64-bit hashes."""
    for batch in sliced(batches):
        sets = [shingle_set(x) for x in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "members"])


# Joins with hot keys -----------------------------------------------------------------------------


def hot_keys(sizes: DataFrame, key: str) -> DataFrame:
    """(key, cuts) for the keys with more than 1 / PARTS of all rows; `sizes` has (key, size).

    There are fewer than PARTS of them, so they can be broadcast; with `cuts` pieces of each, no
    piece is larger than that part, and there are fewer than 2 * PARTS pieces.
    """
    rows = F.coalesce(sizes.agg(F.sum("size").alias("rows")).scalar(), F.lit(0))
    hot = sizes.where(F.col("size") * PARTS > rows)
    return hot.select(F.col(key).alias("_hot"), F.ceil(F.col("size") * PARTS / rows).cast("int").alias("_cuts"))


def joined(rows: DataFrame, facts: DataFrame, key: str, spread: str, hot: DataFrame) -> DataFrame:
    """The inner join of many rows with one row of facts for a key.

    Rows of a hot key are dealt by `spread`, which differs among them, and its facts go to every piece.
    """
    cut = lambda frame: frame.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    piece = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), "_cuts").cast("int"))
    pieces = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_cuts"), F.lit(1)) - 1))
    many = cut(rows).withColumn("_piece", piece).drop("_hot", "_cuts")
    few = cut(facts).withColumn("_piece", pieces).drop("_hot", "_cuts")
    return many.join(few, [key, "_piece"]).drop("_piece")


# Pairs -------------------------------------------------------------------------------------------


def similar(shared: int | np.ndarray, a: int | np.ndarray, b: int | np.ndarray):
    """A similarity of 0.75 or more, in whole numbers."""
    return 100 * shared >= 75 * (a + b - shared)


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sizes allow a link and whose signatures agree in AGREE positions."""
    for batch in batches:
        if not len(batch):
            continue
        a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype=np.uint16).reshape(-1, POSITIONS) for k in (2, 3))
        n, m = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        good = ((a == b).sum(1) >= AGREE) & similar(np.minimum(n, m), n, m)
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good))


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar."""
    for batch in sliced(batches):
        own, other = (batch.column(k).to_pylist() for k in (2, 3))
        good = []
        for x, y in zip(own, other):
            s, t = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            good.append(bool(similar(common(s, t), len(s), len(t))))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, confirmed on their full sets; `a` may be the hub of many."""
    of = lambda name: sets.select(F.col("node").alias(name), F.col("members").alias(f"of_{name}"))
    hubs = hot_keys(pairs.groupBy("a").agg(F.count("*").alias("size")), "a")
    both = joined(pairs, of("a"), "a", "b", hubs).join(of("b"), "b").select("a", "b", "of_a", "of_b")
    return both.mapInArrow(confirmed, "a bigint, b bigint")


# Blocks of large buckets -------------------------------------------------------------------------


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: products of incidence matrices over the shingles in both sides."""
    out = np.zeros((len(sets), len(others)), dtype=np.float32)
    x, y = np.concatenate(sets), np.concatenate(others)
    both = np.intersect1d(np.unique(x), np.unique(y), assume_unique=True)
    row = np.repeat(np.arange(len(sets)), list(map(len, sets)))
    col = np.repeat(np.arange(len(others)), list(map(len, others)))
    at, to = np.searchsorted(both, x), np.searchsorted(both, y)
    if not len(both):
        return out
    in_x, in_y = both[np.minimum(at, len(both) - 1)] == x, both[np.minimum(to, len(both) - 1)] == y
    (row, at), (col, to) = (row[in_x], at[in_x]), (col[in_y], to[in_y])
    step = max(1, CELLS // (len(sets) + len(others)))
    for start in range(0, len(both), step):
        width = min(step, len(both) - start)
        left, right = np.zeros((len(sets), width), np.float32), np.zeros((len(others), width), np.float32)
        for matrix, line, place in ((left, row, at), (right, col, to)):
            here = (place >= start) & (place < start + width)
            matrix[line[here], place[here] - start] = 1
        out += left @ right.T
    return out


def block_edges(table: pa.Table) -> pa.Table:
    """Edges that say which nodes of two blocks of a bucket are connected by links.

    The pairs are taken in strips of rows, as their matrix is large where the sets are small.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    sides = [table.filter(pc.equal(table["side"], k)) for k in (0, 1)]
    if not all(map(len, sides)):
        return schema.empty_table()
    sets = [[np.frombuffer(x, dtype=np.uint64) for x in t["members"].to_pylist()] for t in sides]
    node = [t["node"].to_numpy() for t in sides]
    size = [np.array(list(map(len, s)), dtype=np.float64) for s in sets]
    edges, far = [], node[1]
    step = max(1, PAIRS // len(node[1]))
    for start in range(0, len(node[0]), step):
        own = slice(start, start + step)
        linked = similar(shared_counts(sets[0][own], sets[1]).astype(np.float64), size[0][own, None], size[1][None])
        linked &= node[0][own, None] != node[1][None]
        # The other side goes on with the nodes that it has reached; the edges say from where.
        root, to = block_roots(linked, node[0][own], far)
        edges += [np.stack([node[0][own], root]), np.stack([far, to])]
        far = to
    edges = np.concatenate(edges, axis=1)
    return pa.Table.from_arrays(list(map(pa.array, edges[:, edges[0] != edges[1]])), schema=schema)


def block_links(buckets: DataFrame, sets: DataFrame, hot: DataFrame) -> DataFrame:
    """Edges from the large buckets (key, node): every two members are compared exactly.

    A bucket is dealt to blocks by the bytes of its sets and their number, and every two blocks
    meet in a task, so that no task has more than two blocks and no pair leaves one.
    """
    sized = buckets.join(sets, "node")
    by_bytes = F.ceil(F.sum(F.octet_length("members").cast("long")) / BLOCK_BYTES)
    by_rows = F.ceil(F.count("*") / BLOCK_ROWS)
    blocks = sized.groupBy("key").agg(F.greatest(by_bytes, by_rows).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = joined(sized, blocks, "key", "node", hot).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    # Side 0 is the lower block. A block meets itself with all members on both sides.
    side = F.when(F.col("own") < F.col("other"), F.array(F.lit(0)))
    side = side.when(F.col("own") > F.col("other"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
    dealt = dealt.withColumn("side", F.explode(side)).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "side", "node", "members",
    )
    return dealt.groupBy("key", "low", "high").applyInArrow(block_edges, "a bigint, b bigint").where("a <> b")


# The operator ------------------------------------------------------------------------------------


def near_groups(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: n_shingles, component_id, kept, and stays.

    Texts are linked if the sets of their 5-word shingles have a Jaccard similarity of 0.75 or
    more; component_id is the smallest id that links reach, kept says that it is the row's own.
    stays is true for one row of each component, also where ids repeat or are null (nulls come
    last), and text_key, a hash of the text as it stands, tells rows with the same id apart.
    Null and empty texts, and texts of white space, have no shingles and no links. Other columns
    are not read. Empty in, empty out.

    Texts with equal sets are one class, and only classes are compared. Their signatures meet by
    the pigeonhole keys. Members of small buckets are paired; a large bucket links to its
    smallest member first, and where that doesn't make it one component, all its members are
    compared in blocks. All links are confirmed on the full sets, which are made again for the
    classes that share a key with another.
    """
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    names = [x.split(" ") for x in SKETCH.split(", ")]
    schema = pa.schema([(n, pa.int64() if t == "bigint" else pa.binary()) for n, t in names])
    numbered = rows.select(F.monotonically_increasing_id().alias("at"), "id", "text_key", "text")
    sketches = written(numbered.mapInArrow(lambda b: sketched(b, schema), SKETCH), "sketches")

    of_class = sketches.where("class IS NOT NULL").groupBy("class").agg(F.min("at").alias("node"))
    members = written(sketches.select("at", "id", "text_key", "n", "class").join(of_class, "class", "left").select("at", "id", "text_key", "n", "node"), "classes")
    nodes = of_class.join(sketches.select("at", "id", "text_key", "n", "sketch"), F.col("at") == F.col("node"))
    nodes = written(nodes.select("node", "id", "text_key", "n", "sketch"), "class-heads")

    keys = nodes.select("node", "sketch").mapInArrow(keyed, "key bigint, node bigint")
    shared = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("size"))
    shared = written(shared.where("size > 1"), "shared-keys")
    hot = written(hot_keys(shared, "key"), "hot-keys")
    buckets = written(joined(keys, shared, "key", "node", hot), "buckets")
    wanted = buckets.select("node").distinct().join(nodes.select("node", "id", "text_key"), "node")
    wanted = wanted.select("node", F.col("id").alias("_id"), F.col("text_key").alias("_key"))
    again = rows.join(wanted, (F.col("text_key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id")))
    # Repeated rows are one node, whose set is made and carried once.
    texts = again.groupBy("node").agg(F.first("text").alias("text"))
    sets = texts.select("node", "text").mapInArrow(measured, "node bigint, n bigint, members binary")
    sets = written(sets, "shingle-sets")

    small = buckets.where(F.col("size") <= PAIRED).select("key", "node").join(nodes.select("node", "n", "sketch"), "node")
    one = small.select("key", F.col("node").alias("a"), F.col("sketch").alias("sketch_a"), F.col("n").alias("n_a"))
    two = small.select("key", F.col("node").alias("b"), F.col("sketch").alias("sketch_b"), F.col("n").alias("n_b"))
    near = one.join(two, "key").where("a < b").select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
    near = near.mapInArrow(likely, "a bigint, b bigint")
    large = buckets.where(F.col("size") > PAIRED)
    stars = large.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    pairs = written(near.unionByName(stars).distinct(), "near-candidates")
    found = written(links(pairs, sets), "near-links")

    roots = written(connected(found), "near-roots")
    state = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = state.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    open_ = joined(large.select("key", "node"), apart.where("least <> most").select("key"), "key", "node", hot)
    rest = block_links(written(open_, "open-buckets"), sets.select("node", "members"), hot)
    roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(written(rest, "block-edges")))

    grouped = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node", "at"))
    grouped = written(grouped.select("at", "id", "text_key", "n", "root"), "near-members")
    # Nulls come last: the smallest id, and of rows that share it the first.
    heads = grouped.groupBy("root").agg(
        F.min("id").alias("component_id"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at")).alias("head"),
    )
    return grouped.join(heads, "root").select(
        F.col("id").alias(row_id),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("at") == F.col("head.at")).alias("stays"),
        "text_key",
    )
