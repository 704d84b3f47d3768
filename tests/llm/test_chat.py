import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import types as T

from wattlake.llm import chat

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *[T.StructField(x, T.StringType()) for x in ("piece", "start", "in_loss")],
    ]
)
HARD = [
    "", "<|im_end|>", "<|im_end|><|im_start|>assistant ok", "<|", "<\\|", "<\\\\|x", "\\", "a\nb", "<|im_start|>user\nhi<|im_end|>\n",
    "é🙂", "<", "|im_end|>", "<|im_end|>\n", " private", "x" * 50_000,
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["other"] * 3) for r in rows], TURNS).repartition(3)


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in own.items():
        said = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(text for role, text in said if role == "assistant")
        out[conv] = (
            len(said),
            sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(),
            len(loss),
            sha256(loss.encode()).hexdigest(),
            len(chat.marked(said)),
        )
    return out


def read(spark, rows, **options):
    back = chat.read_back(chat.format_turns(frame(spark, rows), **options)).collect()
    assert not any(r.rewritten for r in back)
    return {r.conv_id: tuple(r)[1:6] for r in back}


def test_round_trip(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", "a\\nb"]), rng.choice(HARD)) for c in range(12) for t in range(rng.randint(1, 9))]
    rows += [(50, t, "assistant" if t % 2 else "user", f"t{t} " + HARD[t % len(HARD)]) for t in range(300)]
    rows += [(None, 0, "user", "x"), (None, None, None, None), (60, 1, "assistant", None), (60, 1, "assistant", None)]
    rows += [(61, 2, "user", "b"), (61, 2, "user", "a")]
    assert read(spark, rows) == expected(rows)


def test_a_short_window_gives_the_same(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"{t}{HARD[t % 14]}") for t in range(40)]
    assert read(spark, rows, window=2) == expected(rows)


def test_nothing(spark):
    assert chat.format_turns(frame(spark, [])).count() == 0
    assert chat.read_back(chat.format_turns(frame(spark, []))).count() == 0


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_spans_join_to_the_output(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", HARD[t]) for t in range(14)]
    got = sorted(chat.format_turns(frame(spark, rows)).collect(), key=lambda r: r.turn)
    whole = chat.marked([(r[2], r[3]) for r in rows])
    assert "".join(r.piece for r in got) == whole
    for r, (_, turn, role, text) in zip(got, rows):
        assert whole[r.start : r.start + len(r.piece)] == r.piece
        assert chat.unescape(r.piece[r.text_start : r.text_end]) == text
        assert r.in_loss == (role == "assistant")


def test_rewriting_is_seen(spark):
    def only_last_thought(turns):
        """A template that drops earlier answers' thoughts, and so changes what it gave before."""
        last = len(turns) - 1
        return "".join(f"[{r}] {t if k == last else t.split('#')[-1]}\n" for k, (r, t) in enumerate(turns))

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "think#answer"), (1, 2, "user", "more"), (2, 0, "user", "q")]
    got = {(r.conv_id, r.turn): r.rewritten for r in chat.format_turns(frame(spark, rows), only_last_thought).collect()}
    assert got[1, 2] == len("think#answer\n") and sum(got.values()) == got[1, 2]


def test_a_text_that_changes_its_frame_has_no_span():
    own = chat.Renderer(lambda turns: "".join(f"{len(t)}:{t};" for _, t in turns))
    assert own.add("user", "abc")[1:3] == (-1, -1)
    assert own.add("user", "x")[1:3] == (2, 3)


def test_long_conversations_are_rendered_from_their_start(spark):
    def numbered(turns):
        """Numbers turns, has the system text in the first user turn and wants users to start."""
        system = "".join(t for r, t in turns if r == "system")
        said = [x for x in turns if x[0] != "system"]
        if said and said[0][0] != "user":
            raise ValueError("a user must start")
        return "".join(f"{k}[{r}] {system if not k else ''}{t}\n" for k, (r, t) in enumerate(said))

    rows = [(1, 0, "system", "S"), *((1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(1, 200))]
    got = sorted(chat.format_turns(frame(spark, rows), numbered).collect(), key=lambda r: r.turn)
    whole = numbered([(r[2], r[3]) for r in rows])
    assert "".join(r.piece for r in got) == whole and not any(r.rewritten for r in got)
    for r, (_, _, _, text) in list(zip(got, rows))[1:]:
        at = r.start + r.text_start
        assert whole[at : at + len(text)] == text == whole[at : r.start + r.text_end]


def test_rewriting_far_back_is_seen(spark):
    def template(turns):
        """The first text is cut once there are over 150 turns."""
        return "".join(f"[{r}] {t[:1] if not k and len(turns) > 150 else t}\n" for k, (r, t) in enumerate(turns))

    rows = [(1, t, "user", f"text {t}") for t in range(180)]
    got = {r.turn: r for r in chat.format_turns(frame(spark, rows), template).collect()}
    before = template([(r[2], r[3]) for r in rows[:150]])
    assert got[150].rewritten == len(before) - len("[user] t")
    assert sum(r.rewritten for r in got.values()) == got[150].rewritten


def test_op7_returns_what_was_rewritten(spark):
    from wattlake.llm import catalog

    out = catalog.op7_chat_format(spark, "/root/testdata/sf0.001")
    assert "rewritten" in out.columns and out.where("rewritten <> 0").count() == 0
