"""Embedding near-dedup: an inverted file with product-quantised residuals, and exact rerank."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.components import block_roots, connected
from wattlake.session import written

#: The index is fitted on the vectors with the lowest hash: so many, or so many for each list if
#: that is more, but never more than these bytes of doubles. All vectors are indexed.
SAMPLE, OF_LIST, SAMPLE_BYTES = 20_000, 16, 1 << 26
#: Coarse lists: between these, by the number of vectors.
LEAST_LISTS, MOST_LISTS = 16, 8192
#: Numbers of a matrix of distances to the centres that are held at once.
CELLS = 4_000_000
#: Neighbours that are made up to find out how far probes must reach.
PLANTED = 20_000
#: Sub-spaces of a residual, and codes of each.
PARTS, CODES = 16, 256
#: Rows of a block of a list, and of a block of queries to it.
BLOCK = 2048
#: Slack for rounding in the bounds, which are of order one.
SLACK = 1e-6


# The index ---------------------------------------------------------------------------------------


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T)


def runs(n: int, width: int) -> Iterator[slice]:
    """Rows 0 to n in runs whose matrices of `width` columns are bounded."""
    step = max(1, CELLS // width)
    return (slice(a, a + step) for a in range(0, n, step))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the centre nearest to each row."""
    found = [squares(x[run], centres).argmin(1) for run in runs(len(x), len(centres))]
    return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


def means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """k centres by Lloyd's rounds from random rows; an empty centre stays where it is."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(own, x[:, d], len(centres))
            centres[:, d] = np.where(n > 0, total / np.maximum(n, 1), centres[:, d])
    return centres


@dataclass(frozen=True)
class Index:
    centres: np.ndarray  # lists x dimensions
    books: list[np.ndarray]  # for each sub-space: codes x its dimensions
    parts: list[tuple[int, int]]  # the dimensions of each sub-space

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes of the residual, and the distance from the vector to what they stand for."""
        lists = nearest(x, self.centres)
        residual = x - self.centres[lists]
        codes = np.empty((len(x), len(self.parts)), dtype=np.uint8)
        error = np.zeros(len(x))
        for m, (a, b) in enumerate(self.parts):
            codes[:, m] = squares(residual[:, a:b], self.books[m]).argmin(1)
            error += ((residual[:, a:b] - self.books[m][codes[:, m]]) ** 2).sum(1)
        return lists, codes, np.sqrt(error)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """How far each row is from the part of space where each centre is the nearer one.

        That part begins at the plane half way between the centre c and the centre c* nearest to
        x, so the distance is (|x-c|^2 - |x-c*|^2) / (2 * |c-c*|); for c* itself it is 0.
        """
        far = squares(x, self.centres)
        own = far.argmin(1)
        apart = np.sqrt(squares(self.centres[own], self.centres))
        return (far - far[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, SLACK)

    def probes(self, x: np.ndarray, within: float) -> list[np.ndarray]:
        """For each vector the lists that lie within a margin.

        A vector of list c is not farther than `within` from x only if the margin of c is not
        more than that; so with the radius of the search as the margin no list is left out.
        """
        found = []
        for run in runs(len(x), len(self.centres)):
            near = self.margins(x[run]) <= within + SLACK
            found += [np.nonzero(row)[0] for row in near]
        return found

    def margin(self, x: np.ndarray, least: float, share: float) -> float:
        """The margin that finds `share` of the neighbours whose cosine is just `least`.

        Neighbours are planted at this cosine around rows of x: one half in a random direction,
        the other half towards another row, since real differences follow the data. Nearer
        neighbours need less. A share of 1 gives the radius, which leaves nothing out.
        """
        radius = sqrt(max(0.0, 2 - 2 * least))
        if share >= 1:
            return radius
        rng = np.random.default_rng(1)
        at = x[rng.integers(0, len(x), PLANTED)]
        to = np.concatenate([rng.normal(size=(PLANTED // 2, x.shape[1])), x[rng.integers(0, len(x), PLANTED - PLANTED // 2)]])
        to -= (to * at).sum(1)[:, None] * at
        length = np.sqrt((to * to).sum(1))
        at, to = at[length > SLACK], to[length > SLACK] / length[length > SLACK][:, None]
        if not len(at):
            return radius
        lists = nearest(least * at + sqrt(1 - least * least) * to, self.centres)
        need = [self.margins(at[run])[np.arange(len(at[run])), lists[run]] for run in runs(len(at), len(self.centres))]
        return min(radius, float(np.quantile(np.concatenate(need), share)))

    def distances(self, x: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from rows of x to coded vectors of one list, added up from tables."""
        residual = x - self.centres[centre]
        out = np.zeros((len(x), len(codes)), dtype=np.float32)
        for m, (a, b) in enumerate(self.parts):
            # A short list has few of the codes: tables of those alone.
            used, place = np.unique(codes[:, m], return_inverse=True)
            table = squares(residual[:, a:b], self.books[m][used]).astype(np.float32)
            out += table[:, place]
        return out


def fit_index(x: np.ndarray, lists: int) -> Index:
    """An index over unit vectors, from a sample of them."""
    centres = means(x, lists, 10, 1)
    residual = x - centres[nearest(x, centres)]
    cuts = np.linspace(0, x.shape[1], min(PARTS, x.shape[1]) + 1).astype(int)
    parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    books = [means(residual[:, a:b], CODES, 6, 2 + m) for m, (a, b) in enumerate(parts)]
    return Index(centres, books, parts)


# Tasks -------------------------------------------------------------------------------------------


def stacked(column: pa.Array) -> np.ndarray:
    """Rows of doubles from binary values of equal length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def units(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The vectors at length one, padded with zeros to `size`, as doubles."""
    for batch in batches:
        made = []
        for vector in batch.column(2).to_pylist():
            x = np.zeros(size)
            x[: len(vector)] = vector
            x /= np.abs(x).max()
            made.append((x / np.sqrt((x * x).sum())).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["at", "label", "unit"]
        )


ENTRY = (
    "query boolean, node bigint, copies bigint, label string, list int, home int, unit binary, "
    "codes binary, error double"
)


def entries(batches: Iterator[pa.RecordBatch], index: Broadcast, margin: float) -> Iterator[pa.RecordBatch]:
    """For each class its entry in the inverted file, and a query to each list to be probed."""
    own = index.value
    for batch in batches:
        if not len(batch):
            continue
        node, copies, label, unit = (batch.column(k) for k in range(4))
        x = stacked(unit)
        lists, codes, error = own.encode(x)
        probes = own.probes(x, margin)
        n = np.fromiter(map(len, probes), dtype=np.int64, count=len(probes))
        row = pa.array(np.concatenate([np.arange(len(x)), np.repeat(np.arange(len(x)), n)]))
        total = int(n.sum())
        columns = [
            pa.array(np.arange(len(row)) >= len(x)),
            node.take(row),
            copies.take(row),
            label.take(row),
            pa.array(np.concatenate([lists, *probes]).astype(np.int32)),
            pa.array(lists.astype(np.int32)).take(row),
            unit.take(row),
            pa.array([c.tobytes() for c in codes] + [None] * total, pa.binary()),
            pa.array(error.tolist() + [None] * total, pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split(" ")[0] for x in ENTRY.split(", ")])


FOUND = "node bigint, links bigint, root bigint"


def cosines(q: np.ndarray, x: np.ndarray, near: np.ndarray, least: float) -> np.ndarray:
    """The pairs of `near` whose cosine is at least `least`.

    Where few pairs are left only their products are made, else all. What comes out next to
    `least` is made again the one way, so that both directions of a pair agree.
    """
    rows, columns = np.nonzero(near)
    if 16 * len(rows) < near.size:
        step = max(1, CELLS // q.shape[1])
        parts = [slice(a, a + step) for a in range(0, len(rows), step)]
        made = [np.einsum("ij,ij->i", q[rows[p]], x[columns[p]]) for p in parts]
        cosine = np.concatenate([np.empty(0), *made])
    else:
        cosine = (q @ x.T)[rows, columns]
    for k in np.nonzero(np.abs(cosine - least) < 1e-12)[0]:
        cosine[k] = (q[rows[k]] * x[columns[k]]).sum()
    out = np.zeros(near.shape, dtype=bool)
    out[rows, columns] = cosine >= least
    return out


def block_links(table: pa.Table, index: Broadcast, within: float, margin: float, least: float) -> pa.Table:
    """Links between the queries and the entries of one block of one list.

    A code stands for a vector that is `error` away from the true one, so an entry can be within
    reach only if its code is within `within` + error: all others are passed over, the rest get
    their exact cosine. Returns the number of linked vectors for each query, and for every node
    that has a link the smallest node it is connected with inside the block. An entry that does
    not probe the list of the query in its turn has the link counted here too.
    """
    own, schema = index.value, pa.schema([(x.split(" ")[0], pa.int64()) for x in FOUND.split(", ")])
    asked = table.filter(table["query"])
    held = table.filter(pc.invert(table["query"]))
    if not len(asked) or not len(held):
        return schema.empty_table()
    q, x = (stacked(t["unit"].combine_chunks()) for t in (asked, held))
    codes = np.frombuffer(b"".join(held["codes"].to_pylist()), dtype=np.uint8).reshape(len(held), -1)
    reach = (within + held["error"].to_numpy() + SLACK) ** 2
    near = own.distances(q, table["list"][0].as_py(), codes) <= reach.astype(np.float32) + np.float32(1e-4)
    node, other = asked["node"].to_numpy(), held["node"].to_numpy()
    near &= node[:, None] != other[None]
    linked = cosines(q, x, near, least)
    rows, columns = np.nonzero(linked.any(1))[0], np.nonzero(linked.any(0))[0]
    if not len(rows):
        return schema.empty_table()
    linked = linked[np.ix_(rows, columns)]
    links = linked @ held["copies"].to_numpy()[columns]
    # Turn about: does the entry ask the list where the query is an entry?
    home = asked["home"].to_numpy()[rows]
    homes, place = np.unique(home, return_inverse=True)
    asks = [own.margins(x[columns[run]])[:, homes] <= margin + SLACK for run in runs(len(columns), len(own.centres))]
    one_way = linked & ~np.concatenate(asks)[:, place].T
    back = asked["copies"].to_numpy()[rows] @ one_way
    root, far = block_roots(linked, node[rows], other[columns])
    return pa.Table.from_arrays(
        [
            pa.array(np.concatenate([node[rows], other[columns]])),
            pa.array(np.concatenate([links, back])),
            pa.array(np.concatenate([root, far])),
        ],
        schema=schema,
    )


# The operator ------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Has values, all of them finite, not all of them zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    whole = F.forall(vector, finite) & F.exists(vector, lambda v: v != 0)
    return F.coalesce(whole, F.lit(False))


def unit_rows(rows: DataFrame) -> DataFrame:
    """(at, label, unit) of the rows that can have links."""
    good = rows.where(F.col("label").isNotNull() & usable(F.col("vector")))
    size = good.agg(F.max(F.size("vector"))).first()[0] or 1
    good = good.select("at", F.col("label").cast("string").alias("label"), F.col("vector").cast("array<double>"))
    return good.mapInArrow(lambda b: units(b, size), "at bigint, label string, unit binary")


def dealt(rows: DataFrame) -> DataFrame:
    """Deal entries and queries of each list to blocks, so that each pair meets in one block."""
    keys = ["label", "list"]
    sizes = rows.groupBy(*keys).agg(
        F.ceil(F.sum((~F.col("query")).cast("int")) / BLOCK).cast("int").alias("of_held"),
        F.ceil(F.sum(F.col("query").cast("int")) / BLOCK).cast("int").alias("of_asked"),
    )
    # Lists without entries or without queries have no pairs.
    sizes = sizes.where("of_held > 0 AND of_asked > 0")
    joined = rows.join(sizes, keys)
    lot = F.xxhash64("node")
    other = F.sequence(F.lit(0), F.when(F.col("query"), F.col("of_held")).otherwise(F.col("of_asked")) - 1)
    joined = joined.withColumn("other", F.explode(other))
    held = F.when(F.col("query"), F.col("other")).otherwise(F.pmod(lot, "of_held").cast("int"))
    asked = F.when(F.col("query"), F.pmod(lot, "of_asked").cast("int")).otherwise(F.col("other"))
    return joined.withColumn("held_block", held).withColumn("asked_block", asked)


def embedding_links(
    vectors: DataFrame,
    least: float = 0.93,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    share: float = 1.0,
) -> DataFrame:
    """One row per vector: `row_id`, n_links, component_id, kept.

    Vectors with equal labels are linked if their cosine in double precision is at least
    `least` (above 0). Null labels and vectors that are null, empty, zero or hold null or
    non-finite values have no links; shorter vectors count as padded with zeros. n_links counts
    the other rows, copies included; component_id is the smallest id that links reach; kept:
    it is the row's own. Repeated rows are copies of each other. Other columns are not read.
    Empty in, empty out.

    Equal vectors are one class with a number of copies. Code distances follow exact bounds from
    the cosine, so they cost no pair. Probes reach as far as `share` says: with 1 no list that
    can hold a link is left out, but in many dimensions that is nearly all of them; with less,
    they find this share of neighbours whose cosine is just `least`, more of nearer ones, and a
    pair is a link for both vectors if either finds the other. No pair below `least` is linked.

    Long lists are cut into blocks, and of the links in a block at most one edge for each node
    leaves it, so that groups of near copies don't give out all their pairs; for that the
    vectors travel with codes and queries.
    """
    context = vectors.sparkSession.sparkContext
    rows = vectors.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "vectors")
    whole = written(unit_rows(rows), "units")
    classes = whole.groupBy("label", "unit").agg(F.min("at").alias("node"), F.count("*").alias("copies"))
    classes = written(classes, "vector-classes")
    count = classes.count()
    if not count:
        return rows.select(
            F.col("id").alias(row_id), F.lit(0).cast("bigint").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )

    length = classes.select(F.octet_length("unit")).first()[0]
    most = max(1, SAMPLE_BYTES // length)
    lists = max(LEAST_LISTS, min(MOST_LISTS, most // OF_LIST, ceil(sqrt(count) / 4)))
    sample = min(most, max(SAMPLE, OF_LIST * lists))
    some = classes.orderBy(F.xxhash64("unit"), "node").limit(sample).select("unit")
    drawn = stacked(some.toArrow()["unit"].combine_chunks())
    fitted = fit_index(drawn, lists)
    margin = fitted.margin(drawn, least, share)
    index = context.broadcast(fitted)
    within = sqrt(max(0.0, 2 - 2 * least)) + SLACK

    cast = classes.select("node", "copies", "label", "unit")
    filed = written(cast.mapInArrow(lambda b: entries(b, index, margin), ENTRY), "inverted-file")
    found = dealt(filed).groupBy("label", "list", "held_block", "asked_block")
    found = found.applyInArrow(lambda t: block_links(t, index, within, margin, least), FOUND)
    found = written(found, "block-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = classes.join(links, "node", "left").join(roots, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    of_class = classes.select(
        F.col("label").alias("_label"),
        F.col("unit").alias("_unit"),
        "root",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    same = (F.col("label") == F.col("_label")) & (F.col("unit") == F.col("_unit"))
    member = whole.join(of_class, same).select(F.col("at").alias("_at"), "root", "n_links")
    member = rows.select("at", "id").join(member, F.col("at") == F.col("_at"), "left")
    member = written(member.withColumn("root", F.coalesce("root", "at")), "vector-members")
    least_id = member.groupBy("root").agg(F.min("id").alias("component_id"))
    return member.join(least_id, "root").select(
        F.col("id").alias(row_id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
