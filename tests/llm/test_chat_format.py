"""Layouts, template, loss mask and reading back."""

from __future__ import annotations

import hashlib

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.llm import chat_format as C
from tierflow.llm.queries import ADDED_CHAT, op13_chat_formatting

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op13_equals_the_rows(spark):
    got = {r.conv_id: r for r in op13_chat_formatting(spark, SF).collect()}
    table = pd.read_parquet(f"{SF}/conversations.parquet").sort_values(["conv_id", "turn"])
    chats = {int(i): list(zip(g.role, g.text.fillna(""), strict=True)) for i, g in table.groupby("conv_id")}
    chats[-7] = [("user", ADDED_CHAT), ("assistant", ADDED_CHAT)]
    assert set(got) == set(chats)
    for i, turns in chats.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = got[i]
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))


def back(spark, chats):
    rows = [(i, [{"role": r, "text": t} for r, t in turns]) for i, turns in enumerate(chats)]
    df = spark.createDataFrame(rows, "id int, turns array<struct<role:string,text:string>>")
    done = C.formatted_chats(C.canonical_turns(df))
    picked = done.select("id", "formatted", "segments", C.read_turns(F.col("formatted")).alias("back"), C.loss_text(F.col("segments")).alias("loss"))
    return [(r.formatted, r.segments, [tuple(t) for t in r.back], r.loss) for r in picked.orderBy("id").collect()]


PIECES = ["<", "[", "\\", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "[SYS] ", " [/SYS]", "[ROLE]", "[/ROLE]", "\n", " ", "ok", "é\U0001f600", "INST]", "$1"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@given(st.lists(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXTS), TEXTS), min_size=1, max_size=5), min_size=10, max_size=30))
@settings(max_examples=6, deadline=None)
def test_round_trip_of_control_strings(spark, chats):
    for turns, (formatted, segments, read, loss) in zip(chats, back(spark, chats), strict=True):
        assert read == turns
        assert loss == "".join(t for r, t in turns if r == "assistant")
        assert "".join(s.text for s in segments) == formatted


def test_long_and_hot_texts(spark):
    long = "a[/INST" * 300_000 + "</s>" + "\\" * 1000 + "<" * 1000
    chats = [[("user", long), ("assistant", long)], [("assistant", "")] * 2000]
    (_, _, read, loss), (_, _, many, none) = back(spark, chats)
    assert read == chats[0] and loss == long and many == chats[1] and none == ""


def turns_of(spark, records, schema):
    rows = C.canonical_turns(spark.createDataFrame(records, schema)).collect()
    return [(r.layout, None if r.chat is None else [tuple(t) for t in r.chat]) for r in rows]


def test_every_layout_maps_to_turns(spark):
    ua = [("user", "q"), ("assistant", "a")]
    schema = "id int, messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, dialog array<string>, history array<array<string>>, " + ", ".join(
        f"{c} string" for c in ("system", "instruction", "input", "context", "output", "response", "prompt", "completion", "question", "answer", "query", "layout")
    )
    def rec(**kw):
        return {"id": 1, "layout": "clash", **kw}

    records = [
        (rec(messages=[{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]), "messages", ua),
        (rec(messages=[{"role": "user", "content": None}, {"role": None, "content": "a"}]), "messages", [("user", ""), ("", "a")]),
        (rec(conversations=[{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]), "conversations", [*ua, ("tool", "t")]),
        (rec(dialog=["q", "a"]), "dialog", ua),
        (rec(instruction="q", output="a"), "instruction", ua),
        (rec(instruction="q", input="", output="a", system="s"), "instruction", [("system", "s"), *ua]),
        (rec(instruction="q", input="i", output="a"), "instruction", [("user", "q\n\ni"), ("assistant", "a")]),
        (rec(instruction="q", output="a", history=[["x", "y"]]), "instruction_history", [("user", "x"), ("assistant", "y"), *ua]),
        (rec(instruction="q", context="c", response="a"), "instruction_response", [("user", "q\n\nc"), ("assistant", "a")]),
        (rec(prompt="q", completion="a"), "prompt_completion", ua),
        (rec(prompt="q", response="a"), "prompt_response", ua),
        (rec(question="q", answer="a"), "question_answer", ua),
        (rec(query="q", response="a"), "query_response", ua),
        (rec(prompt="q"), None, None),
        (rec(prompt="q", completion="a", answer="b"), None, None),
        (rec(), None, None),
        (rec(messages=[]), None, None),
    ]
    assert turns_of(spark, [r for r, _, _ in records], schema) == [(name, turns) for _, name, turns in records]


def test_layouts_by_type_of_the_same_name(spark):
    parts = "messages array<struct<role:string,content:array<struct<type:string,text:string>>>>"
    record = {"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "image", "text": None}, {"type": "text", "text": "r"}]}]}
    assert turns_of(spark, [record, {"messages": None}], parts) == [("message_parts", [("user", "qr")]), (None, None)]
    pairs = "prompt array<struct<role:string,content:string>>, completion array<struct<role:string,content:string>>"
    record = {"prompt": [{"role": "user", "content": "q"}], "completion": [{"role": "assistant", "content": "a"}]}
    assert turns_of(spark, [record], pairs) == [("prompt_messages", [("user", "q"), ("assistant", "a")])]
    assert turns_of(spark, [{"other": 1}], "other int") == [(None, None)]
    assert turns_of(spark, [], pairs) == []


def test_rows_of_turns(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))
    got = C.canonical_turns(C.from_turn_rows(df, ["conv_id"])).collect()
    assert {r.conv_id: [tuple(t) for t in r.chat] for r in got} == {
        1: [("", "first"), ("user", ""), ("user", ""), ("assistant", "b")],
        None: [("user", "x")],
    }
