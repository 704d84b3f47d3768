"""Chat formatting: spans of turns from renderings of successive prefixes of a conversation."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A template: a black box from turns (role, text) to a text.
Template = Callable[[list[tuple[str, str]]], str]

# A template with marks ---------------------------------------------------------------------------

START, END = "<|im_start|>", "<|im_end|>"
#: Any "<|", also one that was escaped before, gets one more backslash, so that no control
#: string is left in a text and each text has its own escaped form.
ESCAPED, UNESCAPED = re.compile(r"<\\(\\*)\|"), re.compile(r"<(\\*)\|")
ROLE_MARKS = {"\\": "\\\\", "\n": "\\n"}


def escape(text: str) -> str:
    return UNESCAPED.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """As a text, and without line ends, which close a role."""
    return escape("".join(ROLE_MARKS.get(c, c) for c in role))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


MARKED = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


# Spans -------------------------------------------------------------------------------------------


class Renderer:
    """Renders a conversation turn by turn; the template is only called, never looked into."""

    def __init__(self, template: Template, window: int | None = None):
        self.template, self.window = template, window
        self.turns: list[tuple[str, str]] = []
        self.before = template([])

    def add(self, role: str, text: str) -> tuple[str, int, int, int]:
        """(what the turn adds to the output, start and end of its text in it, history rewritten).

        The turn is rendered after all turns before it, or the last `window` - 1 of them if that is
        given; what these alone give must be a prefix of that. If it isn't, the template rewrites
        history: the last value says how many characters of it, and what is added starts there. The text's place is found by rendering the turn
        with one unused character instead of the text; it is (-1, -1) if what stands around the
        text hangs on the text.
        """
        turns = self.turns
        if self.window and len(turns) >= self.window:
            del turns[: len(turns) - self.window + 1]
            self.before = self.template(list(turns))
        after = self.template([*turns, (role, text)])
        kept = len(self.before) if after.startswith(self.before) else len(commonprefix([self.before, after]))
        added, rewritten = after[kept:], len(self.before) - kept
        mark = next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in role)
        sample = self.template([*turns, (role, mark)])[kept:]
        start = sample.find(mark)
        end = len(added) - (len(sample) - start - 1)
        if start < 0 or end < start or added[:start] != sample[:start] or added[end:] != sample[start + 1 :]:
            start = end = -1
        turns.append((role, text))
        self.before = after
        return added, start, end, rewritten


TURN = (
    "conv_id bigint, turn bigint, role string, start bigint, piece string, "
    "text_start int, text_end int, in_loss boolean, rewritten int"
)


def schema_of(columns: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split(" ") for x in columns.split(", "))])


def rendered(
    batches: Iterator[pa.RecordBatch], template: Template, loss_roles: set[str], window: int | None
) -> Iterator[pa.RecordBatch]:
    """Turns in, spans out, in order; a conversation may go on over any number of batches."""
    schema = schema_of(TURN)
    conv, own, at = object(), None, 0
    for batch in batches:
        out = []
        for conv_id, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if own is None or conv_id != conv:
                conv, own, at = conv_id, Renderer(template, window), 0
            role, text = role or "", text or ""
            piece, start, end, rewritten = own.add(role, text)
            at -= rewritten
            out.append((conv_id, turn, role, at, piece, start, end, role in loss_roles, rewritten))
            at += len(piece)
        columns = list(zip(*out)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def format_turns(
    turns: DataFrame,
    template: Template = marked,
    loss_roles: tuple[str, ...] = ("assistant",),
    window: int | None = None,
) -> DataFrame:
    """One row per turn of `turns` (conv_id, turn, role, text): its piece of the output.

    start is the place of the piece in the conversation's output, text_start and text_end the
    place of the text in the piece, in_loss whether it is trained on, rewritten the characters of
    earlier output that the template changed (0: none). Null roles and texts count as empty; null
    conversations are one of their own. Turns are in the order of (turn, role, text), nulls
    first; repeated rows are turns of their own. Other columns are not read. Empty in, empty out.

    Partitions hold whole conversations in order and stream through the renderer, which holds
    one conversation and renders each of its prefixes: work grows with the square of its length.
    `window` bounds that to the last turns. It is only for templates that are known to look no
    further back and at nothing but the turns; rewriting is then seen as far back as that.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)
    roles = set(loss_roles)
    return rows.mapInArrow(lambda batches: rendered(batches, template, roles, window), TURN)


# Reading back ------------------------------------------------------------------------------------

BACK = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, rewritten bigint"
)


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Read turns and loss texts back from pieces that come in order; one row per conversation."""
    schema = schema_of(BACK)
    conv, state = object(), None
    for batch in batches:
        out = []
        for conv_id, piece, start, end, in_loss, rewritten in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or conv_id != conv:
                if state:
                    out.append(state.row(conv))
                conv, state = conv_id, ReadBack()
            state.add(piece, piece[start:end] if in_loss else "", rewritten)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * len(schema), schema)], schema=schema
        )
    if state:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(state.row(conv), schema)], schema=schema
        )


class ReadBack:
    """Turns of one conversation, read from the template's marks in its output."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = self.rewritten = 0
        self.all, self.loss, self.rest = sha256(), sha256(), ""

    def add(self, piece: str, masked: str, rewritten: int) -> None:
        self.chars += len(piece)
        self.rewritten += rewritten
        self.rest += piece
        end = 0
        for found in MARKED.finditer(self.rest):
            self.turns += 1
            self.all.update(f"{unescape_role(found[1])}\n{unescape(found[2])}\n".encode())
            end = found.end()
        self.rest = self.rest[end:]
        text = unescape(masked)
        self.loss_chars += len(text)
        self.loss.update(text.encode())

    def row(self, conv_id: int | None) -> tuple:
        return (
            conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars, self.rewritten,
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation of `format_turns` with the template `marked`, as it came from it.

    n_turns and turns_sha256 (role, line end, text, line end for each turn) are parsed from the
    output by its marks; loss_chars and loss_sha256 are the unescaped text under the mask;
    formatted_chars is the length of the output; rewritten the characters changed later.
    """
    pieces = formatted.select("conv_id", "piece", "text_start", "text_end", "in_loss", "rewritten")
    return pieces.mapInArrow(folded, BACK)
