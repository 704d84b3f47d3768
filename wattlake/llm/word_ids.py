"""Ids of a lower-casing word BPE, piece by piece. Used inside Spark's workers."""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import regex

from wattlake.llm.pretokens import Cache, as_letters, special_strings, tokenizer

#: Fixed value: the published pattern of this vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: White space for Python but not for the tokenizer; and the letter whose lower case hangs on
#: its neighbours in Python. Texts with one of them take the library's whole path.
UNLIKE = re.compile("[\x1c-\x1fΣ]")
#: Whether this machine's own unsigned integers are those that are asked for.
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def little_endian(ids: list[int]) -> bytes:
    """Unsigned 32-bit integers. For a few ids an array is made faster than one of NumPy's."""
    return array("I", ids).tobytes() if NATIVE else np.array(ids, dtype="<u4").tobytes()


class WordIds:
    """Ids as the library gives them without begin and end tokens.

    The tokenizer composes characters (NFC), lower-cases, drops white space and splits words;
    nothing of that reaches across white space, so pieces between white space are encoded one
    by one and remembered.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.model = self.library.model
        self.special = tuple(special_strings(path))
        self.tokens = Cache(self.token)
        self.pieces = Cache(self.piece)

    def token(self, token: str) -> bytes:
        # Letters and digits of ASCII stand for themselves in the vocabulary.
        letters = token if token.isascii() and token.isalnum() else as_letters(token)
        return little_endian([x.id for x in self.model.tokenize(letters)])

    def piece(self, piece: str) -> bytes:
        if piece.isalpha():
            return self.token(piece)
        # Words are remembered among the pieces, where most of them occur on their own too.
        tokens, pieces = self.tokens, self.pieces
        return b"".join([pieces[t] if t.isalpha() else tokens[t] for t in WORDS.findall(piece)])

    def ids(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit integers; none for null."""
        text = text or ""
        if UNLIKE.search(text) or ("<|" in text and any(x in text for x in self.special)):
            return little_endian(self.library.encode(text, add_special_tokens=False).ids)
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return b"".join(map(self.pieces.__getitem__, text.lower().split()))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for each worker process, kept from task to task."""
    return WordIds(path)
