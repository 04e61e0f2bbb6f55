from __future__ import annotations

import hashlib
import random
import tracemalloc

import pytest

from tests.llm.helpers import with_clashes
from tidewater.llm.chat import digests, format_turns, parse, parse_turn, render_turn, unescape
from tidewater.llm.queries import EXTRA_TEXT

ROWS = "conv_id long, turn long, role string, text string"


def test_round_trip_of_conflicting_texts():
    rng = random.Random(5)
    parts = ["\\", "#", "###", "### ", "</turn>", " </turn>\n", "<", "\n", "a", " ", "Assistant: ", ":", "n", "="]
    for _ in range(5000):
        turns = [(rng.choice(["user", "assistant", "User", "", ":", "\n#", "a\\"]),
                  "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for _ in range(3)]
        shown = [render_turn(*t) for t in turns]
        assert parse("".join(s for s, _, _ in shown)) == turns
        for (s, a, b), (_, text) in zip(shown, turns, strict=True):
            assert unescape(s[a:b]) == text


def test_plain_texts_are_not_escaped():
    assert render_turn("user", "C:\\dir # 1 < 2")[0] == "### User: C:\\dir # 1 < 2 </turn>\n"
    assert parse_turn(render_turn("user", EXTRA_TEXT)[0])[1] == EXTRA_TEXT


@pytest.mark.parametrize("part", ["plain text ", "\\", "# <", "a ### </turn> b\n"])
def test_memory_of_long_texts_is_a_few_times_their_size(part):
    text = part * (2_000_000 // len(part))
    tracemalloc.start()
    shown = render_turn("user", text)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert parse_turn(shown) == ("user", text, len(shown))
    assert peak < 120 << 20


def expect(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(render_turn(r, t)[0]) for r, t in turns))


def test_digests_of_nulls_ties_repeats_and_a_hot_conversation(spark):
    hot = [(9, k, "assistant" if k % 2 else "user", f"é {k} ### x") for k in range(3000)]
    rows = [(1, 0, "user", None), (1, 1, "assistant", "b"), (2, 5, None, "x"), (2, None, "user", "first"),
            (2, 5, "assistant", "tie"), (2, 5, "assistant", "tie"), (None, 0, "user", "lost"),
            (2**60 + 1, 0, "assistant", EXTRA_TEXT), *hot]
    df = with_clashes(spark.createDataFrame(rows, ROWS).repartition(5), "chunk", "start")
    got = {r["conv_id"]: tuple(r)[1:] for r in digests(format_turns(df)).collect()}
    assert got == {
        1: expect([("user", ""), ("assistant", "b")]),
        2: expect([("user", "first"), ("", "x"), ("assistant", "tie"), ("assistant", "tie")]),
        None: expect([("user", "lost")]), 2**60 + 1: expect([("assistant", EXTRA_TEXT)]),
        9: expect([(r, t) for _, _, r, t in hot])}


def test_masks_and_offsets_of_the_chunks(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a ### b"), (1, 2, "user", "z")]
    chunks = sorted(format_turns(spark.createDataFrame(rows, ROWS)).collect(), key=lambda r: r["position"])
    whole = "".join(r["chunk"] for r in chunks)
    assert [unescape(whole[r["loss_start"]:r["loss_end"]]) for r in chunks] == ["", "a ### b", ""]
    assert all(whole[r["start"]:].startswith(r["chunk"]) for r in chunks)


def test_empty_table(spark):
    assert digests(format_turns(spark.createDataFrame([], ROWS))).count() == 0
