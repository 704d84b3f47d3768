import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from llm.conftest_llm import ODD
from tokenizers import Tokenizer

from wattlake.llm import bpe, packing, pretokens, token_counts, word_ids

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", " ", "\x1c", "1", "½", "٣", "_", "!",
    "<|endoftext|>", "<|startoftext|>", "漢", "é", "A", "z", "ing", " the", "\r\n", "🙂", "aa", "Σ", "İ",
]


def texts(n=3000, seed=1):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "a" * 3000, "ab" * 500, " a" * 400]


def expected(path, given):
    own = Tokenizer.from_file(path)
    return [np.array(x.ids, dtype="<u4").tobytes() for x in own.encode_batch(given, add_special_tokens=False)]


def test_pair_index_encodes_like_the_library():
    given = texts()
    encoder = bpe.Encoder(BYTES)
    want = expected(BYTES, given)
    assert encoder.encode(given) == want
    assert encoder.encode(given[::-1]) == want[::-1]  # now from the cache
    assert [encoder.merges.decode(x) for x in want] == given


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "RUNS", 16)
    given = texts(300)
    encoder = bpe.Encoder(BYTES)
    assert [encoder.encode([x])[0] for x in given] == expected(BYTES, given)
    assert len(encoder.spaced) <= 32


def test_lengths_are_the_librarys():
    given = texts()
    lengths = token_counts.RunLengths(BYTES, {" the": 1})
    assert [lengths.count(x) for x in given] == [len(x) // 4 for x in expected(BYTES, given)]


def test_word_ids_are_the_librarys():
    given = texts()
    own = word_ids.WordIds(WORDS)
    assert [own.ids(x) for x in given] == expected(WORDS, given)


def test_runs_join_to_the_text():
    for text in texts(500):
        assert " ".join(pretokens.runs(text)) == text


def test_count_tokens(odd, none):
    rows = token_counts.count_tokens(odd, BYTES, limit=3).collect()
    size = dict(zip([t for _, t, _ in ODD], expected(BYTES, [t or "" for _, t, _ in ODD])))
    want = Counter((i, len((t or "").encode()), len(size[t]) // 4, len(size[t]) // 4 > 3) for i, t, _ in ODD)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert token_counts.count_tokens(none, BYTES).count() == 0


def test_round_trip(odd, none):
    coded = bpe.encode_texts(odd, BYTES)
    back = bpe.decode_ids(coded, BYTES).collect()
    assert Counter((r.doc_id, r.decoded) for r in back) == Counter((i, t or "") for i, t, _ in ODD)
    digests = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(odd, BYTES).collect())
    want = Counter(
        (r.doc_id, len(r.ids) // 4, sha256(r.ids).hexdigest(), sha256(r.decoded.encode()).hexdigest()) for r in back
    )
    assert digests == want
    assert bpe.round_trip_digests(none, BYTES).count() == 0 and bpe.encode_texts(none, BYTES).count() == 0


def check_packs(rows, given, size):
    ids = {}
    for (i, text, _), own in zip(given, expected(WORDS, [t or "" for _, t, _ in given])):
        ids.setdefault(i, []).append(own + (1).to_bytes(4, "little"))
    pieces = Counter()
    for i, own in ids.items():
        for x in own:
            for a in range(0, len(x) // 4, size):
                part = x[4 * a : 4 * (a + size)]
                pieces[i, a, len(part) // 4, zlib.crc32(part), len(x) // 4] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == pieces
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert max(by_sequence.values()) <= size and sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(by_sequence.values()) / size / len(by_sequence)


def test_pack_documents(odd, none, monkeypatch):
    monkeypatch.setattr("wattlake.llm.ranks.BUCKET_ROWS", 4)
    check_packs(packing.pack_documents(odd, WORDS, size=64).collect(), ODD, 64)
    assert packing.pack_documents(none, WORDS).count() == 0


def test_packs_are_full(docs_of):
    rng = random.Random(3)
    given = [(i, "word " * rng.randint(1, 300), "s") for i in range(600)]
    assert check_packs(packing.pack_documents(docs_of(given), WORDS, size=512).collect(), given, 512) > 0.97


@pytest.mark.parametrize("seed", range(5))
def test_shortest_pack_first(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 100): rng.randint(1, 40) for _ in range(30)}
    placed = packing.shortest_pack_first(histogram, 100)
    fill, ranks = Counter(), {}
    for length, rank, number, pack, offset in placed:
        assert rank == ranks.get(length, 0)
        ranks[length] = rank + number
        for k in range(pack, pack + number):
            assert fill[k] == offset
            fill[k] += length
    assert ranks == histogram and max(fill.values()) <= 100
    assert packing.shortest_pack_first({}, 100) == []


def test_the_shortest_pack_is_filled_first():
    assert packing.shortest_pack_first({6: 1, 5: 1, 3: 1}, 10) == [(6, 0, 1, 0, 0), (5, 0, 1, 1, 0), (3, 0, 1, 1, 5)]
