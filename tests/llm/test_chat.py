import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat

marks = st.sampled_from(["<|turn|>", "<|end|>", "<", "\\", "|", "[INST]", "[/INST]", "</s>", "<\\", "[\\INST]", "a", " "])
hostile = st.lists(marks | st.text(max_size=3), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), hostile), max_size=4))
def test_round_trip(turns):
    formatted = "".join(chat.format_message(role, [{"type": "text", "text": text}]).formatted for role, text in turns)
    assert chat.parse_turns(formatted) == turns


@given(hostile)
def test_escaped_text_holds_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(mark in chat.escape(text) for mark in chat._RESERVED)


def test_parts_in_order_with_attachments():
    message = chat.format_message(
        "user",
        [
            {"type": "text", "text": "see "},
            {"type": "image", "ref": "i.png", "width": 57, "height": 28},
            {"type": "audio", "ref": "a.wav", "seconds": 2.02},
            {"type": "document", "ref": "d.pdf", "pages": 3},
            {"type": None, "text": None},
        ],
    )
    assert message.formatted == "<|turn|>user<|text|>see <|image|><|audio|><|document|><|end|>"
    assert [(a["ref"], a["tokens"]) for a in message.attachments] == [("i.png", 3), ("a.wav", 51), ("d.pdf", 768)]
    assert [message.formatted[a["position"] :].startswith(chat.PLACEHOLDER[a["type"]]) for a in message.attachments] == [True] * 3
    assert message.tokens == 3 + 51 + 768 and message.loss_start == message.loss_end
    with pytest.raises(ValueError):
        chat.format_message("user", [{"type": "smell"}])


def read(frame):
    return {r["conv_id"]: r for r in chat.read_back(chat.format_turns(frame.withColumn("parts", chat.text_parts()))).collect()}


def expected(turns):
    every = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    learned = "".join(t for r, t in turns if r == "assistant")
    return len(turns), every, len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_conversations_read_back(spark, clash):
    rows = [
        (1, 2, "assistant", "two é𝄞"), (1, 0, "system", None), (1, 1, "user", "<|end|>"), (1, 3, "assistant", ""),
        (2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, None, "y"),
        (None, 0, "assistant", "z" * 300_000),
    ]
    frame = clash(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3))
    found = read(frame)
    want = {
        1: [("system", ""), ("user", "<|end|>"), ("assistant", "two é𝄞"), ("assistant", "")],
        2: [("", "y"), ("user", "x"), ("user", "x")],
        None: [("assistant", "z" * 300_000)],
    }
    for conv, turns in want.items():
        got = found[conv]
        assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == expected(turns)
        assert got["formatted_chars"] == sum(len(chat.format_message(r, [{"text": t}]).formatted) for r, t in turns)
    assert read(frame.where("false")) == {}


def test_null_parts_are_an_empty_message(spark):
    frame = spark.createDataFrame([(1, 0, "user")], "conv_id bigint, turn bigint, role string").withColumn("parts", F.lit(None).cast(chat.PARTS))
    assert chat.format_turns(frame).first()["formatted"] == "<|turn|>user<|text|><|end|>"


def test_text_beyond_the_json_parsers_limit(spark):
    long = 21_000_000
    frame = spark.range(1).select(
        F.lit(1).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.lit("assistant").alias("role"),
        F.expr(f"repeat('x', {long})").alias("text"),
    )
    row = chat.read_back(chat.format_turns(frame.withColumn("parts", chat.text_parts()))).first()
    assert row["loss_chars"] == long
    assert row["loss_sha256"] == hashlib.sha256(b"x" * long).hexdigest()
