from __future__ import annotations

import random

from pyspark.sql import functions as F

from mercastar.llm.chat import END, format_chats, loss_text, parsed

NASTY = [
    "", "plain", "</s>[INST] ok [/INST]", "a</s", "\\", "\\e\\l\\o", "[", "<", " [/INST]", "[INST] ", "C:\\lib\\els",
    "é</s>", "a\n[INST] b [/INST]c</s>", "</", "s>", "\\\\l", "<</s>>",
]


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")


def test_everything_comes_back(spark):
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a [/INST]b", "</s>"]), text, "x"))
    out = {r.conv_id: r for r in format_chats(chats(spark, rows)).collect()}
    for c, r in out.items():
        source = [(row[2], row[3]) for row in rows if row[0] == c]
        assert [(t.role, t.text) for t in r.turns] == source and r.round_trip
        assert r.formatted.count(END) == len(source)


def test_plain_text_is_not_escaped(spark):
    rows = [(1, 0, "user", "a [x] < b", None), (1, 1, "assistant", "yes", None)]
    r = format_chats(chats(spark, rows)).first()
    assert r.formatted == "[INST] user [/INST]a [x] < b</s>[INST] assistant [/INST]yes</s>"


def test_loss_covers_each_answer_once(spark):
    rows = [(1, 0, "user", "q", None), (1, 1, "assistant", "</s>a", None), (1, 2, "assistant", "[INST] b", None)]
    chat = format_chats(chats(spark, rows)).withColumn("loss", loss_text(F.col("turns")))
    assert chat.first().loss == "</s>a[INST] b"


def test_nulls_ties_repeats_and_empty(spark):
    assert format_chats(chats(spark, [])).collect() == []
    rows = [(None, None, None, None, None), (None, 1, "user", "x", None), (5, 0, "b", "2", None), (5, 0, "a", "1", None)]
    rows += [(5, 0, "a", "1", None)]
    out = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in format_chats(chats(spark, rows)).collect()}
    assert out == {None: [("", ""), ("user", "x")], 5: [("a", "1"), ("a", "1"), ("b", "2")]}


def test_parser_reads_by_grammar_alone(spark):
    text = "[INST] user [/INST]a\\l/s></s>[INST] assistant [/INST]</s>"
    turns = spark.createDataFrame([(text,)], "t string").select(parsed(F.col("t")).alias("p")).first().p
    assert [(t.role, t.text) for t in turns] == [("user", "a</s>"), ("assistant", "")]


def test_one_long_conversation(spark):
    rows = [(1, i, "user", "w" * 50, None) for i in range(3000)]
    r = format_chats(chats(spark, rows)).first()
    assert len(r.turns) == 3000 and r.round_trip
