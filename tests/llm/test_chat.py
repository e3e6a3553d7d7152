import random

from hypothesis import given
from hypothesis import strategies as st

from lakeload.llm.chat import CONTROL, EVENTS, escape, format_chats, log_of_turns, parse, render, unescape

_texts = st.text(alphabet=st.sampled_from(list("\\<>/s[]INST|\n x")), max_size=25) | st.sampled_from(CONTROL)


@given(st.lists(st.tuples(_texts | st.just("assistant"), _texts), max_size=4))
def test_round_trip(turns):
    formatted, loss = render(turns)
    assert parse(formatted) == turns
    assert [unescape(formatted[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]
    assert not any(c in escape(t) for _, t in turns for c in CONTROL)


def test_events(spark):
    log = [
        (1, 1, "start", 1, "user", None), (1, 2, "delta", 1, None, "hel"), (1, 3, "delta", 1, None, "lo"),
        (1, 4, "start", 2, "assistant", None), (1, 5, "delta", 2, None, "bad"), (1, 6, "regenerate", 2, None, None),
        (1, 7, "delta", 2, None, "good"), (1, 8, "start", 3, "user", None), (1, 9, "delta", 3, None, "lost"),
        (1, 10, "edit", 2, None, "better"), (1, 11, "delta", 3, None, "gone"), (1, 12, "delta", 9, None, "never"),
        (1, 13, "other", 2, None, "x"), (None, 1, "start", 1, None, None), (2, 1, "delta", 1, None, "no start"),
    ]
    random.Random(1).shuffle(log)
    rows = {r.conv_id: r for r in format_chats(spark.createDataFrame(log, EVENTS).repartition(4)).collect()}
    assert parse(rows[1].formatted) == [("user", "hello"), ("assistant", "better")]
    assert parse(rows[None].formatted) == [("", "")] and rows[2].n_turns == 0
    assert format_chats(spark.createDataFrame([], EVENTS)).count() == 0


def test_turns_with_nulls_ties_and_long_texts(spark):
    turns = [
        (1, None, "user", "z"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (1, 1, "assistant", "é" * 70_000), (None, 1, "user", ""), (None, 1, "assistant", "x"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: parse(r.formatted) for r in format_chats(log_of_turns(df)).collect()}
    assert rows[1] == [("user", "z"), ("", ""), ("user", "a"), ("user", "a"), ("user", "b"), ("assistant", "é" * 70_000)]
    assert rows[None] == [("assistant", "x"), ("user", "")]
