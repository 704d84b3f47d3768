"""Cutting texts before byte-pair merges, and the tokenizer files. Used inside Spark's workers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex

#: Before one single space that is followed by no white space, the byte-level pattern always
#: starts a new pre-token: the run of white space before it ends there. So a text may be cut at
#: these places, and the runs between them can be split into pre-tokens one by one.
CUT = re.compile(r" (?=\S)")
NOT_CUT = re.compile(r" (?=\s|$)")

#: Fixed value: the published pattern of byte-level BPE.
BYTE_LEVEL = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Entries of a worker's cache, of short runs. When it is full, the older half is forgotten.
CACHE_ENTRIES = 250_000
CACHED_CHARS = 64


#: Rows that a worker takes from an Arrow batch at a time.
SLICE_ROWS = 1_000


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that Python objects of few rows exist at a time."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def runs(text: str) -> list[str]:
    """The runs of a text; all but the first stand for themselves with a space before them."""
    return CUT.split(text) if NOT_CUT.search(text) else text.split(" ")


def pre_tokens(run: str, spaced: bool) -> list[str]:
    """The pre-tokens of a run; `spaced`: a space belongs before it."""
    if run.isalpha():
        return [" " + run if spaced else run]
    return BYTE_LEVEL.findall(" " + run if spaced else run)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()


def as_letters(token: str) -> str:
    return "".join([LETTERS[b] for b in token.encode()])


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, one for each worker process."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=4)
def special_strings(path: str) -> dict[str, int]:
    return {x["content"]: x["id"] for x in tokenizer_file(path)["added_tokens"]}


def cut_special(text: str, special: dict[str, int]) -> list[tuple[str, int | None]]:
    """(stretch of text, id of the special string after it or None), as the library finds them."""
    if not any(x in text for x in special):
        return [(text, None)]
    pattern = "|".join(re.escape(x) for x in sorted(special, key=len, reverse=True))
    out, at = [], 0
    for found in re.finditer(pattern, text):
        out.append((text[at : found.start()], special[found[0]]))
        at = found.end()
    return [*out, (text[at:], None)]


class Cache(dict):
    """A bounded dict for a worker; `made(key)` gives what is missing."""

    def __init__(self, made, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.made, self.entries = made, entries

    def __missing__(self, key):
        value = self.made(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.entries:
                for old in [k for k, _ in zip(self, range(self.entries // 2))]:
                    del self[old]
            self[key] = value
        return value
