"""Phrase collocations against brute force, with shards cut inside pieces."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import phrases
from wattlake.llm.phrase_index import PhraseIndex

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least, top):
    """Rows of `collocations`, from the definition: every phrase, every longer candidate."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = set()
        for longer, b in candidates.items():
            for m in range(2, len(longer)):
                for i in range(len(longer) - m + 1):
                    inner = longer[i : i + m]
                    if 100 * b >= 80 * candidates[inner]:
                        dropped.add(inner)
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def frame(spark, rows, parts=3):
    more = [(lang, text, "x", "y", 1, "z") for lang, text in rows]
    ddl = "lang string, text string, phrase string, f string, m int, n string"
    return spark.createDataFrame(more, ddl).repartition(parts)


def sample(seed, count=60):
    rng = random.Random(seed)
    words = ["the", "of", "The", "and", "x", "é", "ÀB", "it's", "<|a|>", "w1", "w2", "w3"]
    ends = [". ", ", ", "\n", "! ", "\t", "  ", " "]
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(words[: rng.randint(2, 12)]) + rng.choice(ends[rng.randint(0, 5) :]) for _ in range(rng.randint(0, 120)))
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    return rows + [("en", None), ("en", ""), (None, None), ("de", " . , \t")] + rows[:5] * 2


@pytest.mark.parametrize("shard_bytes", [phrases.SHARD_BYTES, 40, 300])
def test_equals_brute_force(spark, shard_bytes):
    rows = sample(shard_bytes)
    got = phrases.collocations(frame(spark, rows), least=6, top=25, shard_bytes=shard_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, 6, 25)
    assert len(want) > 40
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_all_phrases_and_their_extensions(spark):
    rows = sample(3)
    found, totals = phrases.frequent_phrases(frame(spark, rows), 5, shard_bytes=200)
    got = {(r.lang, r.phrase): r for r in phrases.with_extensions(found).collect()}
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for m in range(1, 5):
                f[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    want = {(lang, " ".join(p)): (a, len(p)) for lang, c in f.items() for p, a in c.items() if a >= 5}
    assert {k: (r.f, r.m) for k, r in got.items()} == want
    for (lang, phrase), r in got.items():
        p = tuple(phrase.split(" "))
        grown = [(q, a) for q, a in f[lang].items() if len(q) == len(p) + 1 and a >= 5]
        assert r.left_f == max([a for q, a in grown if q[1:] == p], default=None)
        assert r.right_f == max([a for q, a in grown if q[:-1] == p], default=None)
    assert {(r.lang, r.n) for r in totals.collect()} >= {("en", sum(a for p, a in f["en"].items() if len(p) == 1))}


def test_intervals_of_the_index():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 5, 400)
    text = "".join(map(str, [*ids.tolist(), 0]))

    def times(p):
        return sum(text.startswith(p, i) for i in range(len(text)))

    index = PhraseIndex(ids)
    level = index.single()
    for left in (True, False, True):
        _, level = index.extensions(level, left)
        names = ["".join(map(str, w)) for w in level.words.tolist()]
        assert level.count.tolist() == [times(p) for p in names]
        want = {text[i : i + len(names[0])] for i in range(len(text) - len(names[0]) + 1)}
        assert set(names) == {p for p in want if "0" not in p} and len(set(names)) == len(names)


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    known = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)], "lang string, phrase string, m int, f bigint"
    )
    row = phrases.with_cuts(known.where("m > 1"), known).first()
    assert row.score == 2000000 * (big - 1) // (2 * big)


def test_ranks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANK_ROWS", 10)
    rows = spark.range(1000).select(F.lit("en").alias("lang"), F.col("id").cast("string").alias("phrase"), (F.col("id") % 7).alias("v"))
    first = phrases.first_of_each(rows, "lang", [F.desc("v"), F.col("phrase")], "phrase", 9, "rank").collect()
    want = sorted((str(i) for i in range(1000) if i % 7 == 6))[:9]
    assert [r.phrase for r in sorted(first, key=lambda r: r.rank)] == want


def test_empty(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(None, None), ("en", "")])).count() == 0


def test_one_very_long_piece(spark):
    rows = [("en", "aa bb cc " * 40_000)]
    got = phrases.collocations(frame(spark, rows, 1), least=30, shard_bytes=30_000).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 30, 2000))
