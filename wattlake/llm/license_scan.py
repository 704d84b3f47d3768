"""License scans: canonical texts, looked up whole by digest."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.licences import SPELLINGS, known
from wattlake.llm.pretokens import sliced

#: A line that may be a copyright claim: a mark, and what follows.
MARKED = re.compile("(?m)^[^a-z0-9\n]*(copyright|\\(c\\)|©)([^\n]*)$".encode())
#: A sign, a placeholder or a year after the mark make it one.
CLAIM = re.compile(rb"[^a-z0-9\n]*(?:\(c\)|\xc2\xa9|[<\[{]|(?:[0-9]{4}|yyyy|xxxx|year)\b)")
#: So does a holder: words of which the first is none of those that licences write after
#: "copyright", and none is of a sentence.
HOLDER = re.compile(rb"(?:[ \t:]|\xe2\x80\x93|--?)+(?:by[ \t]+)?(?=[a-z0-9\x80-\xff])")
TERMS = frozenset(
    b"""act acts also and assignment assignments claim claims disclaimer disclaimers doctrine doctrines
    for grant holder holders infringement infringements information interest interests law laws legend legends licence
    licences license licensed licenses licensing like line lines material materials mark notice notices
    of owned owner owners ownership patent permission permissions permits policy protected protection
    registration related resulting right rights status statement statements term terms trademark
    treaties treaty violation violations work works""".split()
)
SENTENCE = frozenset(
    b"""a above an any applicable apply applies are as at be been below but can do does each either every from
    has have hereby how if in into is it made may means must no nor not on only or otherwise shall should
    such than that their these this those to under unless was were when where whether which who will
    with within without would you your""".split()
)
THINGS = frozenset(b"library material program software work works".split())
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: All ASCII but letters, digits and line ends is read as a space. Letters beyond ASCII stay.
KEPT = b"abcdefghijklmnopqrstuvwxyz0123456789\n"
PLAIN = bytes(x if x >= 128 or x in KEPT else 32 for x in range(256))
SPELLED = [(old.encode(), re.compile(rf"\b{old}\b".encode()), new.encode()) for old, new in SPELLINGS]


def is_claim(mark: bytes, rest: bytes) -> bool:
    """Whether a line in lower case claims a copyright; lines of a licence's body don't.

    Bodies are wrapped anywhere, so "copyright notice", "copyright holders" and the like may open
    a line, and "(c)" an item of a list.
    """
    if CLAIM.match(rest):
        return True
    if mark == b"(c)" and (again := MARKED.match(rest)):
        return is_claim(again[1], again[2])
    if not (lead := HOLDER.match(rest)):
        return False
    own = WORD.findall(rest, lead.end())
    if own[0] == b"the" and (len(own) < 2 or own[1] in THINGS):  # "copyright the software, and (2) offer"
        return False
    return own[0] not in TERMS and not SENTENCE & set(own)


def canonical_lines(text: str | None) -> list[bytes]:
    """The lines that are left of a text: lower case A-Z, no copyright claims, no marks."""
    raw = (text or "").encode().lower()
    if b"copyright" in raw or b"(c)" in raw or "©".encode() in raw:
        raw = MARKED.sub(lambda m: b"" if is_claim(m[1], m[2]) else m[0], raw)
    lines = [b" ".join(x.split()) for x in raw.translate(PLAIN).split(b"\n")]
    plain = b"\n".join(x for x in lines if x)
    for old, pattern, new in SPELLED:
        if old in plain:
            plain = pattern.sub(new, plain)
    return plain.split(b"\n") if plain else []


def digest(lines: list[bytes]) -> str:
    whole = b" ".join(lines)
    for old, pattern, new in SPELLED:
        if b" " in old and old in whole:  # over the end of a line
            whole = pattern.sub(new, whole)
    return sha256(whole).hexdigest()


def known_digests(more: Iterable[tuple[str, str]] = ()) -> dict[str, str]:
    """Digest of the canonical text -> licence id."""
    found: dict[str, str] = {}
    for licence, text in known(more):
        found.setdefault(digest(canonical_lines(text)), licence)
    return found


def scanned(
    batches: Iterator[pa.RecordBatch], notices: dict[str, str], longest: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        whole, found, hits = [], [], []
        for text in batch.column(1).to_pylist():
            lines = canonical_lines(text)
            # A line longer than every known text isn't one.
            own = [notices.get(sha256(x).hexdigest()) for x in lines if len(x) <= longest]
            own = [x for x in own if x]
            whole.append(digest(lines))
            found.append(",".join(sorted(set(own))))
            hits.append(len(own))
        columns = [batch.column(0), pa.array(whole), pa.array(found), pa.array(hits, pa.int64())]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def scan_licenses(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", more: Iterable[tuple[str, str]] = ()
) -> DataFrame:
    """One row per row of `docs`: the licence that its whole text is, and licence notices in it.

    Columns: `row_id`, canonical_sha256, license (null: the text as a whole is no known one),
    notices (sorted ids of the lines that are, each as a whole, a known text, or empty),
    n_notices (lines that are one). Case of A-Z, punctuation, line ends, lines that claim a
    copyright (`is_claim`) and listed spellings don't matter. Null and empty texts have the digest of an empty text and no
    licence. Ids may be null or repeat. Other columns are not read. Empty in, empty out.

    The known digests are a list, joined by hash on the map side; nothing is shuffled. `more`
    adds (id, text) pairs to those of `licences`.
    """
    more = list(more)
    digests = known_digests(more)
    longest = max(len(b" ".join(canonical_lines(x))) for _, x in known(more))
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    schema = pa.schema(
        [("id", pa.int64()), ("canonical_sha256", pa.string()), ("notices", pa.string()), ("n_notices", pa.int64())]
    )
    out = rows.mapInArrow(
        lambda batches: scanned(batches, digests, longest, schema),
        "id bigint, canonical_sha256 string, notices string, n_notices bigint",
    )
    table = docs.sparkSession.createDataFrame(list(digests.items()), "digest string, license string")
    return out.join(F.broadcast(table), F.col("canonical_sha256") == F.col("digest"), "left").select(
        F.col("id").alias(row_id), "canonical_sha256", "license", "notices", "n_notices"
    )
