"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import asinh, exp, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.pretokens import Cache, sliced
from wattlake.llm.survivors import fresh
from wattlake.session import new_path, written

#: Labelled rows that the classifier is fitted on at most (those with the lowest hash of their id,
#: if there are more). Their ids are broadcast: 9 bytes each.
MAX_LABELLED = 400_000
#: Words and stems of a model that is broadcast whole: 12 bytes each. Of a larger one the HEAD most
#: frequent words are broadcast, and the rest is a table that texts are joined with.
BROADCAST_WORDS, HEAD = 1 << 18, 1 << 15
#: Bytes of a word's stem, which speaks for words that are rare among the labelled rows.
STEM = 6
#: Weight of the prior, in tokens: PRIOR spread by the frequencies in all documents, and LEAST
#: for every word.
PRIOR, LEAST = 2_000.0, 0.5
#: Labelled occurrences at which a word weighs as much as its stem.
TRUST = 30.0
#: Standard errors that are taken off a log-odds, and the cost of a token.
ERRORS, DRIFT = 1.0, 0.5
#: Words that a task counts before it hands the counts on.
HELD = 150_000
#: Steps of the histograms that the calibration is made from.
SCORE_STEP, STRENGTH_STEP = 0.01, 0.02
#: The strength of a text without any word that speaks for toxicity, whatever its length.
NOTHING = -5.0

#: All ASCII but letters and digits is read as a space.
WORD_BYTES = b"abcdefghijklmnopqrstuvwxyz0123456789"
PLAIN = bytes(x if x >= 128 or x in WORD_BYTES else 32 for x in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PLAIN).split()


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def stem_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word[:STEM], seed=1) - (1 << 63)


# Counts ------------------------------------------------------------------------------------------

COUNTS = "word bigint, stem bigint, n bigint, clean bigint, toxic bigint"


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a partition: in all its texts, in clean and in toxic ones."""
    every: Counter[bytes] = Counter()
    clean: Counter[bytes] = Counter()
    toxic: Counter[bytes] = Counter()
    schema = pa.schema([(x.split(" ")[0], pa.int64()) for x in COUNTS.split(", ")])

    def of_words() -> pa.RecordBatch:
        own = list(every)
        columns = [
            map(word_key, own), map(stem_key, own), every.values(), [clean[x] for x in own], [toxic[x] for x in own]
        ]
        made = pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema=schema)
        for counter in (every, clean, toxic):
            counter.clear()
        return made

    for batch in sliced(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = words(text)
            every.update(own)
            if label is not None:
                (toxic if label else clean).update(own)
        if len(every) > HELD:
            yield of_words()
    yield of_words()


def log_odds(counts: DataFrame, prior: Column) -> DataFrame:
    """Add `sure`: log-odds of toxic against clean with a Dirichlet prior, less standard errors.

    `prior` is the pseudo-count of a row; the totals are those of `counts`.
    """
    totals = counts.agg(
        F.sum("clean").alias("of_clean"), F.sum("toxic").alias("of_toxic"), F.sum(prior).alias("of_prior")
    ).first()
    whole = [float(totals[x] or 0) for x in ("of_clean", "of_toxic", "of_prior")]
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    value = F.log(a / (whole[1] + whole[2])) - F.log(b / (whole[0] + whole[2]))
    error = F.sqrt(1 / a + 1 / b) * ERRORS
    sure = F.signum(value) * F.greatest(F.lit(0.0), F.abs(value) - error)
    return counts.withColumn("sure", sure)


def word_scores(counts: DataFrame) -> DataFrame:
    """(key, stem, n, score): the words of labelled texts, and the stems that score.

    The score is null for words that are not over the cost of a token and don't stand against a
    stem. A word's log-odds and its stem's are averaged by the word's labelled occurrences. The
    prior of a word comes from its own count in all documents.
    """
    total = counts.agg(F.sum("n")).first()[0] or 1
    own = counts.groupBy("word", "stem").agg(*[F.sum(x).alias(x) for x in ("n", "clean", "toxic")])
    prior = (F.lit(LEAST) + F.lit(PRIOR / total) * F.col("n")).alias("prior")
    own = own.where("clean + toxic > 0").select("word", "stem", "n", "clean", "toxic", prior)
    own = written(own, "toxic-words")
    stems = own.groupBy("stem").agg(
        F.sum("n").alias("n"),
        F.sum("clean").alias("clean"),
        F.sum("toxic").alias("toxic"),
        (F.sum(F.col("prior") - LEAST) + LEAST).alias("prior"),
    )
    stems = log_odds(stems, F.col("prior")).select("stem", F.col("n").alias("of_n"), F.col("sure").alias("of_stem"))
    n = F.col("clean") + F.col("toxic")
    mixed = (n * F.col("sure") + TRUST * F.col("of_stem")) / (n + TRUST) - DRIFT
    scored = log_odds(own, F.col("prior")).join(stems, "stem")
    telling = (mixed > 0) | (F.col("of_stem") > DRIFT)
    listed = scored.select(F.col("word").alias("key"), F.lit(False).alias("stem"), "n", F.when(telling, mixed).alias("score"))
    of_stems = stems.where(F.col("of_stem") > DRIFT).select(
        F.col("stem").alias("key"), F.lit(True).alias("stem"), F.col("of_n").alias("n"), (F.col("of_stem") - DRIFT).alias("score")
    )
    return listed.unionByName(of_stems).withColumn("score", F.col("score").cast("float"))


def arrays(scores: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their scores. For tables of a checked size."""
    rows = scores.select("key", "score").toPandas().sort_values("key")
    return rows["key"].to_numpy(np.int64), rows["score"].to_numpy(np.float32)


def model_of(scores: DataFrame) -> Model:
    """A model without calibration: whole in arrays, or its most frequent words and a table.

    Both forms give every word the same score. Words of the head that tell nothing are in it too,
    so that no frequent word is looked up in the table.
    """
    scores = written(scores, "toxic-scores")
    telling = scores.where("score IS NOT NULL")
    if telling.count() <= BROADCAST_WORDS:
        return Model(arrays(telling.where("NOT stem")), arrays(telling.where("stem")))
    head = scores.where("NOT stem").orderBy(F.desc("n"), "key").limit(HEAD)
    head = arrays(head.withColumn("score", F.coalesce("score", F.lit(-DRIFT).cast("float"))))
    table = new_path(scores.sparkSession, "toxic-table")
    telling.select("key", "score").write.parquet(table)
    return Model(head, arrays(scores.limit(0)), table=table)


# Segments ----------------------------------------------------------------------------------------


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    A segment is maximal if its score is positive, all its parts score less, and no longer
    segment has these properties. Candidates are kept on a stack with the sums before them and
    up to their ends; a new one takes in those that it improves on.
    """
    # start, end, sum before, sum up to the end, the last one before with a lower sum before
    found: list[list] = []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for i in np.nonzero(scores > 0)[0].tolist():
        left, right, start = sums[i], sums[i + 1], i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, i + 1, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, float(right - left)) for a, b, left, right, _ in found]


def best(sums: np.ndarray) -> float:
    """The score of the strongest segment, 0 for none, from the running sums."""
    if not len(sums):
        return 0.0
    lowest = np.minimum.accumulate(np.concatenate([[0.0], sums[:-1]]))
    return max(0.0, float((sums - lowest).max()))


@dataclass(frozen=True)
class Model:
    """Scores of words and stems (sorted keys, scores), and the calibration.

    `table` is the Parquet folder of all scores if they are too many for a broadcast; `words` are
    then the most frequent ones.
    """

    words: tuple[np.ndarray, np.ndarray]
    stems: tuple[np.ndarray, np.ndarray]
    rate: float = 1.0
    log_k: float = 0.0
    intercept: float = -1.0
    slope: float = 1.0
    table: str | None = None


class Scorer:
    """Scores of words and texts under a model; used inside Spark's workers."""

    def __init__(self, model: Model):
        self.model = model
        self.words = Cache(self.word)
        #: What the model's table says on the words of the present text.
        self.entries: dict[int, float] = {}

    def word(self, word: bytes) -> float:
        for (keys, scores), key in (
            (self.model.words, word_key(word)),
            (self.model.stems, stem_key(word)),
        ):
            at = int(np.searchsorted(keys, key))
            if at < len(keys) and keys[at] == key:
                return float(scores[at])
        if self.entries:
            return self.entries.get(word_key(word), self.entries.get(stem_key(word), -DRIFT))
        return -DRIFT

    def scores(self, text: str | None) -> np.ndarray:
        own = words(text)
        return np.fromiter(map(self.words.__getitem__, own), dtype=float, count=len(own))

    def told(self, keys: np.ndarray | list | None, scores: np.ndarray | list | None) -> None:
        """Take the entries of the model's table for the text that comes next."""
        self.entries = {} if keys is None else {int(k): float(x) for k, x in zip(keys, scores)}

    def least(self, count: int) -> float:
        """The score from which a segment among `count` words is significant.

        Fewer than one segment so strong is then expected in clean text of this length:
        rate * score > ln(K * words).
        """
        return (self.model.log_k + log(count + 1)) / self.model.rate

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """(first word, end, score) of every significant segment.

        One pass over the running sums tells whether there can be any.
        """
        scores = self.scores(text)
        least = self.least(len(scores))
        if best(np.cumsum(scores)) < max(least, 1e-9):
            return []
        return [x for x in segments(scores) if x[2] >= least]

    def strength(self, text: str | None) -> tuple[float, int]:
        """How far the segments exceed what clean text has, and the number of passages.

        The excesses of the significant segments are added; without any, it is the (negative)
        distance of the strongest segment. A text without any segment has the strength NOTHING.
        """
        scores = self.scores(text)
        top, least = best(np.cumsum(scores)), self.least(len(scores))
        over = [x[2] - least for x in segments(scores) if x[2] >= least] if top >= max(least, 1e-9) else []
        if not top:
            return NOTHING, 0
        return self.model.rate * (sum(over) if over else top - least), len(over)

    def score(self, text: str | None) -> tuple[float, int]:
        strength, passages = self.strength(text)
        # The inverse hyperbolic sine keeps the order, and strong passages from outweighing all.
        z = self.model.intercept + self.model.slope * asinh(strength)
        return 1 / (1 + exp(-max(-500.0, min(500.0, z)))), passages


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """The rate r > 0 with mean(exp(r * score)) = 1: the tail of segment scores in clean text.

    Without positive scores, or with a mean that isn't negative, there is none: then it is 1.
    """
    if not weights.sum() or scores[weights > 0].max() <= 0 or (scores * weights).sum() >= 0:
        return 1.0
    share = weights / weights.sum()
    over = lambda r: (share * np.exp(np.minimum(r * scores, 700))).sum() > 1
    low, high = 1e-6, 1.0
    while not over(high) and high < 8:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if over(middle) else (middle, high)
    return low


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(intercept, slope) of a ridge logistic regression in one variable; n: how often a row is."""
    if not len(x) or y.min() == y.max():
        return (-1.0, 1.0)
    design = np.stack([np.ones(len(x)), x], axis=1)
    w = np.zeros(2)
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (p - y)) + 1e-2 * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 1e-3))


# Fitting -----------------------------------------------------------------------------------------


def fold(row_id: Column) -> Column:
    """crc32 of the id as text, modulo 5. Fold 0 is held out; fold 4 calibrates, the rest train."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % 5


def labelled(labels: DataFrame, row_id: str, limit: int) -> DataFrame:
    """At most `limit` rows (id, label, fold) that may be learned from, one for each id.

    Ids with both labels count as toxic; null ids and labels are left out.
    """
    rows = labels.where(F.col(row_id).isNotNull() & F.col("toxic").isNotNull())
    rows = rows.where(fold(F.col(row_id)) != 0).groupBy(F.col(row_id).cast("bigint").alias("id"))
    rows = rows.agg((F.max("toxic") > 0).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(limit).withColumn("fold", fold(F.col("id")))


def asked(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    """(row, key): the words of each text that the head of the model doesn't have, and their stems."""
    head = model.value.words[0]
    for batch in sliced(batches):
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = list(set(words(text)))
            keys = np.fromiter(map(word_key, own), dtype=np.int64, count=len(own))
            stems = np.fromiter(map(stem_key, own), dtype=np.int64, count=len(own))
            other = ~np.isin(keys, head)
            keys = np.unique(np.concatenate([keys[other], stems[other]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), row)), pa.array(keys)], names=["row", "key"])


def told(rows: DataFrame, text: str, model: Model) -> tuple[DataFrame, Column, Column]:
    """`rows`, with the keys and scores that the model's table has for each text (null: none).

    Only a model that is too large for a broadcast has a table. A text then asks for each of its
    rarer words once; the answers of a text are no more than its words.
    """
    none = F.lit(None)
    if model.table is None:
        return rows, none.cast("array<bigint>"), none.cast("array<float>")
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)
    row, found = fresh(rows, "row"), fresh(rows, "found")
    rows = written(rows.withColumn(row, F.monotonically_increasing_id()), "toxic-rows")
    keys = rows.select(F.col(row), F.col(text)).mapInArrow(lambda b: asked(b, sent), "row bigint, key bigint")
    answers = keys.join(spark.read.parquet(model.table), "key").groupBy(F.col("row").alias(row))
    answers = answers.agg(F.collect_list(F.struct("key", "score")).alias(found))
    return rows.join(answers, row, "left").drop(row), F.col(found)["key"], F.col(found)["score"]


def measured(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    """Per text of the calibration fold: its label, words, positive segments, counts of scores."""
    scorer = Scorer(model.value)
    for batch in sliced(batches):
        rows = []
        for text, label, keys, known in zip(*(batch.column(k).to_pylist() for k in range(4))):
            scorer.told(keys, known)
            scores = scorer.scores(text)
            bins, n = np.unique(np.round(scores / SCORE_STEP).astype(np.int64), return_counts=True)
            rows.append((label, len(scores), [x[2] for x in segments(scores)], bins.tolist(), n.tolist()))
        columns = list(zip(*rows)) or [[]] * 5
        types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)],
            names=["label", "words", "segments", "bins", "n"],
        )


def fit(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", limit: int = MAX_LABELLED) -> Model:
    """Fit the scores on folds 1 to 3 of the labelled rows, the calibration on fold 4.

    At most `limit` labelled rows are used; the prior comes from all documents. Without labels
    of both kinds no word scores, and every text has the same low score.
    """
    context = docs.sparkSession.sparkContext
    known = written(labelled(labels, row_id, limit), "toxic-labels")
    texts = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    train = F.broadcast(known.where("fold < 4").select("id", "label"))
    counts = texts.join(train, "id", "left").select("text", "label").mapInArrow(counted, COUNTS)
    model = model_of(word_scores(written(counts, "toxic-counts")))

    sent = context.broadcast(model)
    check = F.broadcast(known.where("fold = 4").select("id", "label"))
    rows, keys, known_scores = told(texts.join(check, "id").select("text", "label"), "text", model)
    rows = written(
        rows.select("text", "label", keys.alias("keys"), known_scores.alias("scores")).mapInArrow(
            lambda batches: measured(batches, sent),
            "label int, words bigint, segments array<double>, bins array<bigint>, n array<bigint>",
        ),
        "toxic-check",
    )
    clean = rows.where("label = 0")
    spread = clean.select(F.explode(F.arrays_zip("bins", "n")).alias("x")).groupBy("x.bins")
    spread = spread.agg(F.sum("x.n").alias("n")).toPandas()
    rate = decay(spread["bins"].to_numpy(float) * SCORE_STEP, spread["n"].to_numpy(float))
    top = F.coalesce(F.array_max("segments"), F.lit(0.0))
    # The mean of an extreme value of this kind is ln(K * words) plus Euler's constant.
    mean = clean.agg(F.avg(rate * top - F.log(F.col("words") + 1.0))).first()[0]
    log_k = (mean if mean is not None else 0.0) - 0.5772156649
    least = (F.lit(log_k) + F.log(F.col("words") + 1.0)) / rate
    over = F.expr("filter(segments, x -> x >= least)")
    total = F.expr("aggregate(filter(segments, x -> x >= least), 0D, (a, x) -> a + x - least)")
    strength = rate * F.when(F.size(over) > 0, total).otherwise(top - F.col("least"))
    strength = F.when(top > 0, strength).otherwise(F.lit(NOTHING))
    bins = rows.withColumn("least", least)
    bins = bins.groupBy("label", F.round(F.asinh(strength) / STRENGTH_STEP).alias("bin"))
    bins = bins.agg(F.count("*").alias("n")).toPandas()
    x, y, n = (bins[c].to_numpy(float) for c in ("bin", "label", "n"))
    intercept, slope = logistic(x * STRENGTH_STEP, y, n)
    return replace(model, rate=rate, log_k=log_k, intercept=intercept, slope=slope)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add the struct `name`: score (0 to 1), passages (number of significant ones).

    One row per row, and equal texts get equal scores; nothing is shuffled unless the model has a
    table. Null and empty texts get the score of no words. Empty in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, passages int")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for batch in batches:
            rows = []
            for own, keys, scores in zip(*batch):
                scorer.told(keys, scores)
                rows.append(scorer.score(own))
            yield pd.DataFrame(rows, columns=["score", "passages"])

    rows, *entries = told(docs, text, model)
    extra = [c for c in rows.columns if c not in docs.columns]
    return rows.withColumn(name, scored(F.col(text), *entries)).drop(*extra)


def passages(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per significant passage: `row_id`, first and end (words), strength.

    Null and empty texts have none; repeated rows and null ids have theirs each. Empty in, empty out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<first: int, end: int, strength: double>>")
    def found(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for batch in batches:
            rows = []
            for own, keys, scores in zip(*batch):
                scorer.told(keys, scores)
                rows.append(scorer.passages(own))
            yield pd.Series(rows, dtype=object)

    rows, *entries = told(docs.select(row_id, text), text, model)
    rows = rows.select(row_id, F.explode(found(F.col(text), *entries)).alias("_x"))
    return rows.select(row_id, "_x.first", "_x.end", "_x.strength")
