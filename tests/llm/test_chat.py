from hypothesis import given, settings
from hypothesis import strategies as st

import compare
from meterlake.llm import chat, queries

TEXT = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "\n", "a", "<<SYS>>", "<</SYS>>", "s>", "<", " ", "é"]), max_size=25).map("".join)


@given(TEXT)
@settings(max_examples=500, deadline=None)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._OWN.search(chat.escape(text))


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", ""]), TEXT), TEXT), max_size=6))
@settings(max_examples=500, deadline=None)
def test_rendering_reads_back(messages):
    text, mask = chat.render(messages)
    assert chat.parse(text) == messages
    assert [chat.unescape(text[a:b]) for a, b in mask] == [t for r, t in messages if r == "assistant"]


def test_folding():
    log = [
        (1, "message", "user", "que"), (1, "delta", None, "stion"), (2, "delta", "assistant", "fir"), (2, None, None, "st"), (2, "regenerate", None, None), (2, "delta", None, "sec"), (2, "delta", None, "ond"),
        (3, "message", "user", "typo"), (3, "edit", "other", "fixed"), (4, "message", "user", "gone"), (4, "delete", None, None), (9, "edit", None, "x"), (9, "regenerate", None, None), (9, "delete", None, None), (4, "delta", "user", "back")]
    assert chat.fold(log) == [("user", "question"), ("assistant", "second"), ("user", "fixed"), ("user", "back")]


def test_log_in_any_order(spark):
    rows = [(7, 3, 2, "delta", None, "lo"), (7, 1, 1, "message", "user", "hi"), (7, 2, 2, "delta", "assistant", "hel"), (None, 1, 1, "message", None, None), (8, 5, 1, "edit", "user", "nothing there"), (7, 4, 2, None, None, "!")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, seq long, message long, event string, role string, text string, formatted string")
    got = {r["conv_id"]: chat.parse(r["formatted"]) for r in chat.conversations(df).collect()}
    assert got == {7: [("user", "hi"), ("assistant", "hello!")], None: [("", "")], 8: []}
    assert chat.conversations(df.limit(0)).count() == 0


def test_repeated_and_tied_turns(spark):
    rows = [(1, 0, "user", "same"), (1, 0, "user", "same"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, None, None, None), (2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, None) for r in rows], "conv_id long, turn int, role string, text string, mask string")
    out = chat.read_back(chat.conversations(chat.events_of_turns(df)))
    got = {r["conv_id"]: (r["n_turns"], r["loss"]) for r in out.collect()}
    assert got == {1: (5, "".join(sorted("ab"))) if got[1][1] == "ab" else (5, "ba"), 2: (1, "")}


def test_query_equals_sql(spark, sf_dir):
    con = compare.connect(sf_dir)
    assert compare.differences(queries.QUERIES["op5_chat"](spark, sf_dir), con, queries.ORACLE["op5_chat"]) == []
    assert compare.differences(queries.QUERIES["op7_exact_dedup"](spark, sf_dir), con, queries.ORACLE["op7_exact_dedup"]) == []
