import random

import pytest

from millrace.sources import captures


def decode(spark, tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"capture-{i}.txt").write_bytes(text.encode())
    rows = captures.decode_frames(spark, str(tmp_path)).sort("file", "frame").collect()
    return [(r["id"], r["event"], r["data"]) for r in rows]


CASES = {
    "single frame": ('id: 1\nevent: message\ndata: {"a": 1}\n\n', [("1", "message", '{"a": 1}')]),
    "several data lines": ("data: one\ndata: two\n\n", [(None, None, "one\ntwo")]),
    "comment": (": keep-alive\ndata: x\n\n", [(None, None, "x")]),
    "id holds until changed": (
        "id: 1\ndata: a\n\ndata: b\n\nid: 2\ndata: c\n\n",
        [("1", None, "a"), ("1", None, "b"), ("2", None, "c")],
    ),
    "frame without data": ("id: 1\n\ndata: x\n\n", [("1", None, "x")]),
    "field without colon": ("data\n\n", [(None, None, "")]),
    "id with NUL": ("id: 1\ndata: a\n\nid: 2\0\ndata: b\n\n", [("1", None, "a"), ("1", None, "b")]),
    "empty id": ("id: 1\ndata: a\n\nid\ndata: b\n\n", [("1", None, "a"), ("", None, "b")]),
    "event is per frame": ("event: e\ndata: a\n\ndata: b\n\n", [(None, "e", "a"), (None, None, "b")]),
    "unterminated": ("data: a\n\ndata: b\n", [(None, None, "a")]),
    "unterminated, no line end": ("data: a\n\ndata: b", [(None, None, "a")]),
    "windows line ends": ("id: 1\r\ndata: a\r\n\r\ndata: b\r\n\r\n", [("1", None, "a"), ("1", None, "b")]),
    "runs of blank lines": ("\n\ndata: a\n\n\n\ndata: b\n\n", [(None, None, "a"), (None, None, "b")]),
    "one space stripped": ("data:  two\ndata:none\n\n", [(None, None, " two\nnone")]),
    "retry and unknown fields": ("retry: 5\nfoo: x\ndata: a\n\n", [(None, None, "a")]),
    "colons in the value": ("data: a:b: c\n\n", [(None, None, "a:b: c")]),
    "last event wins": ("event: a\nevent: b\ndata: x\n\n", [(None, "b", "x")]),
}


@pytest.mark.parametrize("case", CASES)
def test_rules(spark, tmp_path, case):
    text, expected = CASES[case]
    assert decode(spark, tmp_path, text) == expected


def test_ids_do_not_leak_between_connections(spark, tmp_path):
    assert decode(spark, tmp_path, "id: 1\ndata: a\n\n", "data: b\n\n") == [
        ("1", None, "a"),
        (None, None, "b"),
    ]


def test_empty_payloads_are_not_forwarded(spark, tmp_path):
    (tmp_path / "c.txt").write_text("data\n\ndata: x\n\n")
    frames = captures.decode_frames(spark, str(tmp_path))
    assert [r["data"] for r in captures.with_payload(frames).collect()] == ["x"]


def by_hand(text):
    """The rules, line by line."""
    frames, data, event, last = [], [], None, None
    for row in text.split("\n")[: text.count("\n")]:
        name, _, value = row.partition(":")
        value = value.removeprefix(" ")
        if row == "":
            if data:
                frames.append((last, event, "\n".join(data)))
            data, event = [], None
        elif name == "data":
            data.append(value)
        elif name == "event":
            event = value
        elif name == "id" and "\0" not in value:
            last = value
    return frames


@pytest.mark.parametrize("block_bytes", [7, 64, 1000])
def test_a_capture_split_into_blocks_decodes_like_a_whole_one(spark, tmp_path, block_bytes):
    rng = random.Random(block_bytes)
    parts = ["data: x{0}\n", "data:\n", "id: {0}\n", "id: \0\n", "event: e{0}\n", ": c\n", "\n", "\n"]
    text = "".join(rng.choice(parts).format(n) for n in range(400))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        decoded = decode(spark, tmp_path, text)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert decoded == by_hand(text)
    assert len(decoded) > 20


def test_lines_are_dealt_without_their_path_and_without_those_that_mean_nothing(spark, tmp_path):
    (tmp_path / "c.txt").write_text(": keep-alive\nretry: 10\nid: 1\ndata: a\n\nid: \0\nfoo\n" + ": c\n" * 50)
    lines = captures._read_lines(spark, str(tmp_path))
    assert lines.count() == 3
    assert "file" not in captures._pieces(lines).columns


def test_captures_that_share_a_hash_are_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(captures.F, "xxhash64", lambda *_: captures.F.lit(1).cast("bigint"))
    assert decode(spark, tmp_path, "data: a\n\n") == [(None, None, "a")]
    with pytest.raises(Exception, match="two captures with one hash"):
        decode(spark, tmp_path, "data: a\n\n", "data: b\n\n")
