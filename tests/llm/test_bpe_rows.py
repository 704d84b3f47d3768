"""Merging a rank's positions one by one and all at once."""

import random

import public_tokenizers
import pytest

from wattlake.llm import bpe
from wattlake.llm.pretokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("at_once", [1, 3, 10**9])
def test_both_ways_give_the_ids_of_the_library(monkeypatch, at_once):
    monkeypatch.setattr(bpe, "AT_ONCE", at_once)
    rng = random.Random(4)
    parts = ["ab", "th", "the", "in", "ing", "aa", "aaaa", "er", "ee", "é", "ß", "日本", "0", "00", "--", "!!", "\n"]
    tokens = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    tokens += ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 40)] + ["", " the", "the" * 500]
    texts = [f"{t} {u}" for t, u in zip(tokens, reversed(tokens))]
    own = bpe.Encoder(PATH)
    assert own.merges.steady
    want = [b"".join(i.to_bytes(4, "little") for i in x.ids) for x in tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want
    assert [own.merges.decode(x) for x in want] == texts


def test_rules_in_any_order(monkeypatch):
    """A rule may make a pair of a lower rank; then positions are merged one by one."""
    monkeypatch.setattr(bpe, "AT_ONCE", 1)
    own = bpe.Merges(PATH)
    own.steady = False
    assert own.encode(["there there", "aaaa", ""]) == bpe.Encoder(PATH).merges.encode(["there there", "aaaa", ""])
