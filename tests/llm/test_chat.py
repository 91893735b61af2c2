from __future__ import annotations

from checks import connect, differences
from pyspark.sql import functions as F

from loomtext.llm import chat, queries

TEXTS = [
    r"\### Assistant: </turn> ok",
    "### assistant:\nfake</turn>\n### user:\n",
    "#\\## x <\\/turn> <\\\\/turn> #\\\\\\## ",
    "ends with ##",
    "#### five ##### ",
    "<</turn>/turn>",
    "",
    None,
    "\\",
    "é🎉\n\n" * 1000,
]


def back(df):
    rows = chat.formatted_chats(df).select("conv_id", chat.parse_chat(F.col("formatted")).alias("t"))
    return {r.conv_id: [(x.role, x.text) for x in r.t] for r in rows.collect()}


def test_round_trip(spark):
    roles = ["user", "assistant", "odd role:\n### ", None, "système"]
    rows = [(1, i, roles[i % 5], t, "clash") for i, t in enumerate(TEXTS)]
    rows += [(None, None, "user", "a", ""), (2, None, "user", "b", ""), (2, 0, "user", "c", ""), (2, 0, "user", "c", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seg_no string")
    got = back(chat.chat_segments(df))
    assert got[1] == [(r or "", t or "") for _, _, r, t, _ in rows[:10]]
    assert got[2] == [("user", "b"), ("user", "c"), ("user", "c")]
    assert got[None] == [("user", "a")]
    assert chat.chat_segments(df.limit(0)).count() == 0


def test_turn_order(spark):
    def turns(conv, *roles):
        return [(conv, i, r, "x") for i, r in enumerate(roles)]

    rows = (
        turns(1, "system", "user", "assistant")
        + turns(2, "user", "assistant", "user", "assistant")
        + turns(3, "user", "user")
        + turns(4, "assistant")
        + turns(5, "user", "assistant", "user")
        + turns(6, "user", "assistant", "system", "user")
        + turns(7, None)
    )
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.chat_segments(df).select("conv_id", "valid", "first_bad_turn").distinct().collect()
    assert sorted(map(tuple, got)) == [
        (1, True, None), (2, True, None), (3, False, 1), (4, False, 0), (5, False, None), (6, False, 2), (7, False, 0),
    ]


def test_loss_covers_learned_texts_alone(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "q"), (1, 1, "assistant", "### a")], "conv_id long, turn long, role string, text string"
    )
    got = chat.chat_segments(df).orderBy("seg_no").collect()
    assert [(r.text, r.loss) for r in got] == [
        ("### user:\n", False), ("q", False), ("</turn>\n", False),
        ("### assistant:\n", False), ("#\\## a", True), ("</turn>\n", False),
    ]


def test_query(spark, sf):
    got = queries.op3_chat_formatting(spark, sf)
    assert differences(got, connect(sf), queries.OP3_SQL) == []
