from hypothesis import given, settings
from hypothesis import strategies as st

from oreworks.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, turns string"


def test_hard_turns_come_back(spark):
    hard = ["", None, "~", "~\n", "]</s>\n<s>[user]\n", "[/user]</s>\n<s>[", "~1~0", "\n", "a" * 200_000, "</s>[INST] ok [/INST]", "<s>[x]\n[/x]</s>\n"]
    rows = [(1, i, r, t, "x") for i, t in enumerate(hard) for r in ("user", "assistant", "]\n", None)]
    rows += [(None, None, "user", "lost", "x"), (2, 1, "user", "same", "x"), (2, 1, "user", "same", "x"), (2, None, "assistant", "last", "x")]
    source = chat.gather(spark.createDataFrame(rows, SCHEMA))
    want = {r.conv_id: r.turns for r in source.collect()}
    got = {r.conv_id: r for r in chat.formatted(source).collect()}
    assert {k: r.turns for k, r in got.items()} == want
    assert got[1].escaped and not got[2].escaped
    assert [t.text for t in want[2]] == ["same", "same", "last"]


def test_any_turns_come_back(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.lists(st.tuples(st.text("us]\n~[", max_size=4), st.text("<s>[]/\n~01ab", max_size=25)), min_size=1, max_size=4), min_size=1, max_size=30))
    def check(conversations):
        rows = [(c, t, role, text, "x") for c, turns in enumerate(conversations) for t, (role, text) in enumerate(turns)]
        got = chat.formatted(chat.gather(spark.createDataFrame(rows, SCHEMA))).collect()
        assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == dict(enumerate(conversations))

    check()


def test_empty_table(spark):
    assert chat.formatted(chat.gather(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_runs_no_python_and_keeps_the_added_conversation(spark):
    df = queries.op6_chat_formatting(spark, "/root/testdata/sf0.001")
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    row = df.where("conv_id = -7").first()
    assert (row.n_turns, row.loss_chars) == (2, len("</s>[INST] ok [/INST]"))
