"""Ids of the word BPE: the library's, with each word merged once."""

import numpy as np
import public_tokenizers

from wattlake.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


class Counting:
    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, token):
        self.asked.append(token)
        return self.model.tokenize(token)


def test_a_word_is_merged_once_with_and_without_signs():
    own = WordIds(PATH)
    own.model = Counting(own.model)
    own.ids("Zyxomma zyxomma, (zyxomma) zyxomma's zyxomma2")
    assert own.model.asked.count("zyxomma") == 1


def test_ids_are_the_librarys():
    own = WordIds(PATH)
    texts = [
        "Plain words, and 'signs' it's we'll 2024 x2y _a_ \x00\x7f", "Größe naïve ½ ² ١٢ 東京。東京", "é ﬁ ǅ İ ſ ''s 's",
        "a​b a b c\n\t d", "", " ", "Σίσυφος ΣΑΣ", "\x1c\x1d x",
    ]
    for text in texts * 2:
        want = own.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == want
