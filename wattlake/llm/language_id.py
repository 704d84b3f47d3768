"""Language identification: a byte network learns from labelled rows and judges whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.byte_network import BATCH, PAD, ByteNetwork, in_blocks
from wattlake.llm.pretokens import sliced

#: Labelled rows that the network learns from: so many of each language as a mean, and in all. Of
#: each row it sees one piece of so many characters, at a place that the row's hash sets.
ROWS_OF_EACH, MOST_ROWS, PIECE = 4_000, 24_000, 400
#: Language of texts without letters.
UNKNOWN = "und"
#: Bytes that are part of letters: a-z and all beyond ASCII.
LETTER_BYTES = np.array([97 <= b <= 122 or 128 <= b < PAD for b in range(PAD + 1)])


def fold(row_id: Column, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo `folds`. A null id counts as an empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % folds


@dataclass
class LanguageModel:
    """Languages in order of the network's outputs; the network is None with nothing to learn."""

    languages: list[str]
    network: ByteNetwork | None


def training_pieces(rows: DataFrame, each: int = ROWS_OF_EACH, most: int = MOST_ROWS) -> DataFrame:
    """lang, piece: pieces of rows (lang, text) that a hash of the text picks evenly.

    The same number of rows of each language is expected; at most `most` come back.
    """
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()  # one output of the network each
    quota = float(max(1, min(each, most // max(1, languages))))
    counts = counts.select(F.col("lang").alias("_lang"), (quota / F.col("n")).alias("_share"))
    lot = F.xxhash64("text")
    even = F.pmod(lot, F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.pmod(F.shiftrightunsigned(lot, 32), F.greatest(F.length("text") - PIECE, F.lit(1)))
    piece = F.substring(F.col("text"), place.cast("int") + 1, F.lit(PIECE))
    picked = rows.select("lang", even.alias("even"), piece.alias("piece"))
    picked = picked.join(F.broadcast(counts), picked["lang"] == counts["_lang"]).where("even < _share")
    return picked.orderBy("even", "lang", "piece").limit(most).select("lang", "piece")


def fit(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", lang: str = "lang",
    folds: int = 4, held_out: int = 2,
) -> LanguageModel:
    """Learn from the rows with a language and letters whose fold is not `held_out`.

    The driver trains on a bounded sample (see MOST_ROWS) in a fixed order, so the same table gives
    the same network.
    """
    rows = docs.where(F.col(lang).isNotNull() & (fold(F.col(row_id), folds) != held_out)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    found = training_pieces(rows.where(has_letters(F.col("text")))).toArrow()
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    if not languages:
        return LanguageModel([], None)
    number = {name: k for k, name in enumerate(languages)}
    pieces = [x.encode().lower() for x in found["piece"].to_pylist()]
    network = ByteNetwork(len(languages))
    if len(languages) > 1:
        network.train(pieces, np.array([number[x] for x in names]))
    return LanguageModel(languages, network)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def judged(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    """The mean of the windows' probabilities, weighed by their letters."""
    languages, network = model.value
    for batch in sliced(batches):
        texts = [(x or "").encode().lower() for x in batch.column(1).to_pylist()]
        sums = np.full((len(texts), len(languages)), 1e-9)
        for symbols, owner in in_blocks(texts):
            weight = LETTER_BYTES[symbols].sum(axis=1)
            some = weight > 0
            for start in range(0, int(some.sum()), BATCH):
                own = np.nonzero(some)[0][start : start + BATCH]
                p = network.probabilities(symbols[own])
                np.add.at(sums, owner[own], p * weight[own, None])
        best = sums.argmax(axis=1)
        score = sums[np.arange(len(texts)), best] / sums.sum(axis=1)
        chosen = pa.array(languages, pa.string()).take(pa.array(best))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), chosen, pa.array(score), batch.column(2)],
            names=["id", "lang_pred", "score", "letters"],
        )


def identify(docs: DataFrame, model: LanguageModel, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `row_id`, lang_pred, score (0 to 1).

    The whole text counts, in windows of a fixed length; the score is the language's share of their
    probabilities. A null text, or one without a letter, is `und` with score 0, and so is every text
    if there was nothing to learn from. Ties go to the language that comes first by name. Ids may be
    null or repeat; equal texts get equal results. Empty in, empty out. Other columns are not read,
    and nothing is shuffled.
    """
    rows = docs.select(
        F.col(row_id).cast("bigint").alias("id"),
        F.col(text).alias("text"),
        has_letters(F.col(text)).alias("letters"),
    )
    if model.network is None:
        return rows.select(F.col("id").alias(row_id), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.network))
    out = rows.mapInArrow(
        partial(judged, model=sent), "id bigint, lang_pred string, score double, letters boolean"
    )
    return out.select(
        F.col("id").alias(row_id),
        F.when(F.col("letters"), F.col("lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(F.lit(0.0)).alias("score"),
    )
