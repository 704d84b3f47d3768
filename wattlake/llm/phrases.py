"""Phrase collocations: an FM-index per shard counts phrases, the shards' counts are added up.

A shard is a block of a partition's words. Short phrases are counted first; a shard then extends
only phrases whose parts may be frequent, by a Bloom filter of the frequent ones. The filter has a
bounded size and never loses a frequent phrase; a false positive costs a row that the sums drop.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from wattlake.llm.phrase_index import DEPTH, END, PhraseIndex
from wattlake.llm.pretokens import sliced
from wattlake.llm.shingles import PLACE, mixed
from wattlake.session import written

#: Bytes of text of a shard. While its index is made, it takes some 25 times as much.
SHARD_BYTES = 4_000_000
#: Bits of the Bloom filter for each frequent phrase, and its largest size (16 MB). Beyond 8
#: million frequent phrases of a length it lets more through; no count hangs on it.
BITS_EACH, MOST_BITS = 16, 1 << 27
#: Candidates that one task ranks on average.
RANK_ROWS = 20_000
#: Rows of an Arrow batch that a worker emits.
ROWS = 50_000

#: What shards emit: the language, a line end, the words of a phrase with spaces between them; and
#: its occurrences. Words have no line ends. Without a phrase: the words of the language.
COUNTS = pa.schema([("key", pa.string()), ("f", pa.int64())])
COUNTS_DDL = "key string, f bigint"

# --- words ----------------------------------------------------------------------------

#: A-Z in lower case; every byte that ends a piece becomes a full stop, a tab a space.
_END_BYTES = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(
    ord(".") if b in _END_BYTES else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
STOP = b"."


def slices(text: str | None, size: int) -> Iterator[tuple[bytes, bytes]]:
    """A text in slices of some `size` bytes, with STOP as a word of its own where a piece ends.

    Also the words that a slice repeats from the one before, at most DEPTH - 1, so that every
    phrase lies in one slice as a whole.
    """
    data = (text or "").encode().translate(_PLAIN)
    at, repeated = 0, b""
    while at < len(data):
        end = at + size
        if end < len(data):
            cuts = [x for x in (data.find(b" ", end), data.find(STOP, end)) if x >= 0]
            end = min(cuts, default=len(data))
        piece = repeated + b" " + data[at:end].replace(STOP, b" . ")
        yield piece, repeated
        at, repeated = end, b" ".join(piece.rsplit(None, DEPTH - 1)[1 - DEPTH :])


@lru_cache(maxsize=1024)
def lang_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, lang_seed(lang))


def phrase_hashes(hashes: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes."""
    total = np.full(len(hashes), hashes.shape[1], dtype=np.uint64)
    for k in range(hashes.shape[1]):
        total += hashes[:, k] * PLACE[k]
    return mixed(total)


class Filter:
    """Bits of the frequent phrases of one length."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, dtype=np.uint8)
        self.mask = np.uint64(len(self.bits) * 8 - 1)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(place, 64 bits) of a filter of `bits` bits that holds the phrases, all of one length."""
    for batch in batches:
        hashes = [
            word_hash(lang, word)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for word in phrase.encode().split(b" ")
        ]
        if not hashes:
            continue
        at = phrase_hashes(np.array(hashes, dtype=np.uint64).reshape(len(batch), -1)) & np.uint64(bits - 1)
        word = np.uint64(1) << (at & np.uint64(63))
        columns = [(at >> np.uint64(6)).astype(np.int64), word.view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["place", "word"])


def filter_of(frequent: DataFrame) -> Broadcast:
    """A Bloom filter of (lang, phrase), sent to all workers; its size is bounded by MOST_BITS."""
    wanted = BITS_EACH * max(64, frequent.count())
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    some = frequent.select("lang", "phrase").mapInArrow(
        partial(filter_words, bits=bits), "place bigint, word bigint"
    )
    words = some.groupBy("place").agg(F.bit_or("word").alias("word")).toArrow()
    held = np.zeros(bits // 64, dtype="<i8")
    held[words["place"].to_numpy()] = words["word"].to_numpy()
    return frequent.sparkSession.sparkContext.broadcast(held.tobytes())


# --- shards ---------------------------------------------------------------------------


class Shard:
    """Texts of one language as ids. `sign` is what an occurrence counts."""

    def __init__(self, lang: str, texts: list[bytes], sign: int):
        self.lang, self.sign = lang, sign
        joined = pa.array([b" . ".join(texts).strip(b" ")], pa.binary()).cast(pa.string())
        coded = pc.ascii_split_whitespace(joined).flatten().dictionary_encode()
        self.words = pa.concat_arrays([pa.array([STOP.decode()]), coded.dictionary])
        stop = pc.index(coded.dictionary, STOP.decode()).as_py()
        ids = coded.indices.to_numpy().astype(np.int64)
        self.ids = np.where(ids == stop, END, ids + 1)

    def hashes(self) -> np.ndarray:
        made = (word_hash(self.lang, x) for x in self.words.cast(pa.binary()).to_pylist())
        return np.fromiter(made, dtype=np.uint64, count=len(self.words))

    def index(self, words_filter: Filter, hashes: np.ndarray) -> PhraseIndex:
        """The index of the text; a word that cannot be frequent ends a piece."""
        kept = words_filter.may_hold(phrase_hashes(hashes[:, None]))
        kept[END] = False
        ids = np.where(kept[self.ids], self.ids, END)
        return PhraseIndex(ids[(ids != END) | np.concatenate([[True], ids[:-1] != END])])

    def rows(self, words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Phrases, given as rows of ids, with their counts."""
        for start in range(0, len(words), ROWS):
            some = words[start : start + ROWS]
            parts = [self.words.take(pa.array(some[:, k])) for k in range(some.shape[1])]
            phrase = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]
            key = pc.binary_join_element_wise(self.lang, phrase, "\n")
            yield pa.RecordBatch.from_arrays([key, pa.array(counts[start : start + ROWS] * self.sign)], schema=COUNTS)


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Shard]:
    """The documents (lang, text) in shards of some `size` bytes, apart by language.

    Words that a slice of a long text repeats would count twice: they come again with sign -1.
    """
    held: dict[tuple[str, int], list[bytes]] = {}
    total = 0
    for batch in sliced(batches):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for piece, repeated in slices(text, size):
                held.setdefault((lang, 1), []).append(piece)
                if repeated:
                    held.setdefault((lang, -1), []).append(repeated)
                total += len(piece)
                if total >= size:
                    yield from (Shard(lang, texts, sign) for (lang, sign), texts in held.items())
                    held, total = {}, 0
    yield from (Shard(lang, texts, sign) for (lang, sign), texts in held.items())


def single_words(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Counts of words, and the number of all words of a language under an empty phrase."""
    for shard in shards(batches, size):
        counts = np.bincount(shard.ids, minlength=len(shard.words))
        words = np.nonzero(counts[1:])[0] + 1
        yield from shard.rows(words[:, None], counts[words])
        whole = [pa.array([f"{shard.lang}\n"]), pa.array([int(counts[1:].sum()) * shard.sign])]
        yield pa.RecordBatch.from_arrays(whole, schema=COUNTS)


def pairs(batches: Iterator[pa.RecordBatch], words: Broadcast, size: int) -> Iterator[pa.RecordBatch]:
    """Counts of two-word phrases whose words may both be frequent."""
    words_filter = Filter(words.value)
    for shard in shards(batches, size):
        index = shard.index(words_filter, shard.hashes())
        _, found = index.extensions(index.single(), left=False)
        yield from shard.rows(found.words, found.count)


def longer(
    batches: Iterator[pa.RecordBatch], words: Broadcast, two: Broadcast, size: int
) -> Iterator[pa.RecordBatch]:
    """Counts of three- and four-word phrases all of whose pairs may be frequent.

    A pair grows to the left, and what comes of it to the right.
    """
    words_filter, two_filter = Filter(words.value), Filter(two.value)
    for shard in shards(batches, size):
        hashes = shard.hashes()

        def frequent(some, first):
            return two_filter.may_hold(phrase_hashes(hashes[some.words[:, first : first + 2]]))

        index = shard.index(words_filter, hashes)
        _, found = index.extensions(index.single(), left=False)
        found = found.where(frequent(found, 0))
        for left in (True, False):
            _, found = index.extensions(found, left)
            found = found.where(frequent(found, 0 if left else found.words.shape[1] - 2))
            yield from shard.rows(found.words, found.count)


# --- all shards -----------------------------------------------------------------------


def frequent_phrases(
    docs: DataFrame, least: int, text: str = "text", lang: str = "lang", shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 4 words that occur at least `least` times in their language.

    Columns lang, phrase, m (its words), f (occurrences). And the words of each language:
    lang, n. `docs` is read three times. Both tables are written down.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    phrase = F.substring_index("key", "\n", -1)
    named = F.expr("left(key, length(key) - length(phrase) - 1)")

    def summed(counted, label: str) -> DataFrame:
        sums = rows.mapInArrow(counted, COUNTS_DDL).groupBy("key").agg(F.sum("f").alias("f"))
        sums = sums.withColumn("phrase", phrase).where((F.col("f") >= least) | (F.col("phrase") == ""))
        words = F.size(F.split("phrase", " ")).alias("m")
        return written(sums.select(named.alias("lang"), "phrase", words, "f"), f"phrases-{label}")

    first = summed(partial(single_words, size=shard_bytes), "1")
    totals = first.where("phrase = ''").select("lang", F.col("f").alias("n"))
    words = first.where("phrase != ''")
    word_filter = filter_of(words)
    two = summed(partial(pairs, words=word_filter, size=shard_bytes), "2")
    rest = summed(partial(longer, words=word_filter, two=filter_of(two), size=shard_bytes), "3")
    return words.unionByName(two).unionByName(rest), totals


def with_extensions(phrases: DataFrame) -> DataFrame:
    """Add left_f and right_f: how often the most frequent phrase occurs that has one more word
    before or after. Null where none is in `phrases`."""
    w = F.split("phrase", " ")
    grown = phrases.where("m > 1").select(
        "lang",
        F.explode(
            F.array(
                F.struct(F.array_join(F.slice(w, F.lit(2), F.col("m") - 1), " ").alias("inner"),
                         F.col("f").alias("left_f"), F.lit(None).cast("bigint").alias("right_f")),
                F.struct(F.array_join(F.slice(w, F.lit(1), F.col("m") - 1), " ").alias("inner"),
                         F.lit(None).cast("bigint").alias("left_f"), F.col("f").alias("right_f")),
            )
        ).alias("e"),
    )
    most = grown.groupBy(F.col("lang").alias("_lang"), F.col("e.inner").alias("_phrase")).agg(
        F.max("e.left_f").alias("left_f"), F.max("e.right_f").alias("right_f")
    )
    same = (phrases["lang"] == most["_lang"]) & (phrases["phrase"] == most["_phrase"])
    return phrases.join(most, same, "left").drop("_lang", "_phrase")


def with_cuts(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Add the cut with the lowest score: l and r, the counts of its parts, and the score.

    Products are decimals, so they are exact beyond 64 bits.
    """
    w = F.split("phrase", " ")
    cut = candidates.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cut = cut.withColumns(
        {
            "_first": F.array_join(F.slice(w, F.lit(1), F.col("_k")), " "),
            "_rest": F.array_join(F.slice(w, F.col("_k") + 1, F.col("m") - F.col("_k")), " "),
        }
    )
    for part, count in (("_first", "l"), ("_rest", "r")):
        known = phrases.select(
            F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(count)
        )
        same = (cut["lang"] == known["_lang"]) & (cut[part] == known["_part"])
        cut = cut.join(known, same).drop("_lang", "_part", part)
    score = F.expr("cast(f as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r)")
    worst = F.min(F.struct(score.alias("score"), "_k", "l", "r")).alias("_worst")
    least = cut.groupBy("lang", "phrase", "m", "f").agg(worst)
    return least.select("lang", "phrase", "m", "f", "_worst.l", "_worst.r", "_worst.score")


def first_of_each(rows: DataFrame, group: str, order: list, salt: str, limit: int, rank: str) -> DataFrame:
    """The first `limit` rows of each group, numbered from 1.

    A group is first cut by a hash of `salt` into parts of some RANK_ROWS rows, of which each gives
    its own first ones, until one task can rank what is left.
    """
    left = written(rows, "ranked")
    parts = ceil(left.count() / max(RANK_ROWS, 4 * limit))
    while parts > 1:
        part = F.pmod(F.xxhash64(salt), F.lit(parts))
        own = W.Window.partitionBy(group, part).orderBy(*order)
        left = left.withColumn(rank, F.row_number().over(own)).where(F.col(rank) <= limit).drop(rank)
        left = written(left, "ranked")
        parts = min(parts - 1, ceil(left.count() / max(RANK_ROWS, 4 * limit)))
    own = W.Window.partitionBy(group).orderBy(*order)
    return left.withColumn(rank, F.row_number().over(own).cast("bigint")).where(F.col(rank) <= limit)


def collocations(
    docs: DataFrame,
    least: int = 30,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The `top` collocations of each language: phrases of 2 to 4 words, by how firmly they cohere.

    Texts in lower case (A-Z) are cut at `.,;:!?` and line ends into pieces, these at spaces and tabs
    into words. A candidate occurs a >= `least` times. Its score is the lowest floor(2000000 a /
    (l + r)) of all its cuts into two parts that occur l and r times; equal scores go to the cut
    nearest its start. It is dropped when it lies in a longer candidate that occurs at least four
    fifths as often; that is so just when this holds for one with a single word more. Order: score
    and a descending, then the phrase by bytes, so there are no ties. A null text is empty, a null
    language is `und`; a language without candidates has no rows. Repeated rows count as often as
    they are there. Empty in, empty out. Other columns are not read.
    Columns: lang, rank (from 1), phrase, a, l, r, n (words of the language), score.
    """
    phrases, totals = frequent_phrases(docs, least, text, lang, shard_bytes)
    contained = F.greatest("left_f", "right_f") * 5 >= F.col("f") * 4
    apart = with_extensions(phrases.where("m > 1")).where(~F.coalesce(contained, F.lit(False)))
    scored = with_cuts(apart.select("lang", "phrase", "m", "f"), phrases)
    order = [F.desc("score"), F.desc("f"), F.col("phrase")]
    first = first_of_each(scored, "lang", order, "phrase", top, "rank")
    return first.join(totals, "lang").select(
        "lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score"
    )
