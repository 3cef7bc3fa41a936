"""Formatting against exact round trips and a plain recomputation."""

import hashlib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from songloom.llm.chat_format import GrammarError, format_digests, format_turn, formatted_turns, parse_turns

PIECES = ["###", "#", "\\", "</turn>", "</turn", ">", "\n", ":", "### User:\n", " ", "é", "\r", "x"]
texts = st.lists(st.sampled_from(PIECES), max_size=14).map("".join)


@given(st.lists(st.tuples(texts, texts), max_size=5))
@settings(max_examples=400, deadline=None)
def test_any_turns_come_back(turns):
    assert parse_turns("".join(format_turn(r, t) for r, t in turns)) == turns


@pytest.mark.parametrize("text", ["\\" * 1_000_000, "\\" * 1_000_000 + "###", "\\###" * 100_000, "</turn>\n" * 100_000])
def test_long_texts_take_linear_time(text):
    begun = time.perf_counter()
    assert parse_turns(format_turn("user", text)) == [("user", text)]
    assert time.perf_counter() - begun < 5


def test_only_conflicting_text_is_escaped():
    assert format_turn("user", "a ## b \\ c") == "### user:\na ## b \\ c\n</turn>\n"
    assert "\\###" in format_turn("user", "### x")
    with pytest.raises(GrammarError):
        parse_turns("### user:\nno end")


def expected(turns):
    spoken = [t or "" for r, t in turns if r == "assistant"]
    return (
        len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest(),
        sum(map(len, spoken)), hashlib.sha256("".join(spoken).encode()).hexdigest(),
    )


def test_digests_of_many_conversations(spark):
    r = random.Random(5)
    rows = []
    for conv in range(40):
        for turn in range(3000 if conv == 3 else r.randint(1, 6)):
            text = r.choice(["", None, "ä" * 300, "\\### Assistant: </turn> ok", "".join(r.choices(PIECES, k=9))])
            rows.append((conv, turn, r.choice(["user", "assistant", "system", None]), text, "extra"))
    shuffled = rows[:]
    r.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string, rendered string")
    got = {g.conv_id: tuple(g)[1:5] for g in format_digests(formatted_turns(frame)).collect()}
    assert got == {c: expected([(x[2], x[3]) for x in rows if x[0] == c]) for c in range(40)}


def test_empty_and_null_ids(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert format_digests(formatted_turns(spark.createDataFrame([], schema))).count() == 0
    frame = spark.createDataFrame([(None, 0, "user", "a"), (None, None, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], schema)
    assert sorted(((g.conv_id, g.n_turns) for g in format_digests(formatted_turns(frame)).collect()), key=str) == [(1, 2), (None, 2)]
