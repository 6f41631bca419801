import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filigree.llm import chat_format as c

PIECES = st.lists(st.sampled_from(["a", "\n", "<", "|", "\\", ">", c.START, c.END, "<|", "|>", "<\\|im_end|>", "é"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=5))
def test_round_trip(turns):
    text, escaped = c.render(turns)
    assert c.parse(text) == turns
    if not any("\\" in x or "<" in x or "\n" in r for r, x in turns for x in (r, x)):
        assert escaped == 0


@pytest.mark.parametrize("bad", ["x", c.START, c.START + "r\n", c.START + "r\nx" + c.END, c.START + "r\n" + c.START + c.END + "\n"])
def test_grammar_errors(bad):
    with pytest.raises(c.GrammarError):
        c.parse(bad)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_nulls_order_and_repeats(spark):
    rows = [(1, 2, "assistant", "hi"), (1, 1, "user", "hello"), (1, 1, "user", "hello"), (1, None, None, None), (None, 1, "user", "x"), (2, 1, "user", c.END), (3, 1, "", "")]
    out = {r["conv_id"]: r for r in c.format_chats(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rendered", "2 as t", "3 as turns")).collect()}
    assert c.parse(out[1]["rendered"]) == [("user", "hello"), ("user", "hello"), ("assistant", "hi"), ("unknown", "")]
    assert out[1]["n_turns"] == 4 and out[2]["n_escaped"] == 1 and out[1]["n_escaped"] == 0
    assert c.parse(out[2]["rendered"]) == [("user", c.END)] and c.parse(out[3]["rendered"]) == [("", "")]
    assert c.parse(out[None]["rendered"]) == [("user", "x")]


def test_empty_and_very_long(spark):
    assert c.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    text = ("word " + c.END) * 50_000
    out = c.format_chats(spark.createDataFrame([(1, 1, "user", text)], SCHEMA)).collect()[0]
    assert c.parse(out["rendered"]) == [("user", text)]
