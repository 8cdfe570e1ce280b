"""Chat formatting: typed content parts become one string per conversation turn.

A visitor walks the parts of a message. Text is escaped; an image, audio clip or document
becomes a run of placeholders, one per token it will be expanded to, and is recorded as an
attachment with its place. The template marks every turn:

    <|turn|>ROLE<|text|>CONTENT<|end|>

Texts may hold any of the control strings. A backslash after the first character takes their
meaning away, and one more backslash is added to those already escaped, so that reading back
gives the text unchanged. Formatting is row by row; a conversation is the concatenation of
its turns, so that no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import prepare

# The template's own marks, and those of other common templates, which are
# escaped too so that a tokenizer that knows them can't be misled.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
FOREIGN = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

#: What an attachment is expanded to: pixels a side of an image patch, audio tokens a second,
#: tokens a document page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 256

_RESERVED = [TURN, TEXT, END, *PLACEHOLDER.values(), *FOREIGN]
_TAILS = "|".join(re.escape(mark[1:]) for mark in sorted(_RESERVED, key=len, reverse=True))
_ESCAPE = re.compile(rf"([<\[])(?=\\*(?:{_TAILS}))")
_UNESCAPE = re.compile(rf"([<\[])\\(?=\\*(?:{_TAILS}))")
_MARK = re.compile("|".join(map(re.escape, [TURN, TEXT, END])))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class Message:
    """What one turn becomes. Offsets are code points from the turn's first character."""

    formatted: str = ""
    loss_start: int = 0
    loss_end: int = 0
    tokens: int = 0
    attachments: list[dict] = field(default_factory=list)


class Visitor:
    """Flattens the parts of one message, in order."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.expanded = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown part type {kind!r}")
        handler(part)

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        patches = math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH)
        self._attach("image", part, patches)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * PAGE_TOKENS)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        tokens = max(1, tokens)
        self.attachments.append({"type": kind, "ref": part.get("ref"), "position": self.length, "tokens": tokens})
        self.expanded += tokens
        self._write(PLACEHOLDER[kind])

    def _write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def format_message(role: str | None, parts: list[dict]) -> Message:
    visitor = Visitor()
    for part in parts:
        visitor.visit(part)
    head = TURN + escape(role or "") + TEXT
    content = "".join(visitor.pieces)
    learned = len(content) if role == "assistant" else 0
    for attachment in visitor.attachments:
        attachment["position"] += len(head)
    return Message(head + content + END, len(head), len(head) + learned, visitor.expanded, visitor.attachments)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` of every turn in a formatted string, unescaped."""
    turns, role, start, state = [], "", 0, END
    for mark in _MARK.finditer(formatted):
        if mark[0] == TURN and state == END:
            pass
        elif mark[0] == TEXT and state == TURN:
            role = unescape(formatted[start : mark.start()])
        elif mark[0] == END and state == TEXT:
            turns.append((role, unescape(formatted[start : mark.start()])))
        else:
            raise ValueError(f"unexpected {mark[0]} at {mark.start()}")
        state, start = mark[0], mark.end()
    if state != END or start != len(formatted):
        raise ValueError("the string ends within a turn")
    return turns


PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("role", pa.string()),
        ("sequence", pa.int64()),
        ("formatted", pa.string()),
        ("loss_start", pa.int32()),
        ("loss_end", pa.int32()),
        ("expanded_tokens", pa.int64()),
        (
            "attachments",
            pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("position", pa.int64()), ("tokens", pa.int64())])),
        ),
    ]
)
_FORMATTED_DDL = (
    "conv_id bigint, turn bigint, role string, sequence bigint, formatted string, loss_start int, loss_end int, "
    "expanded_tokens bigint, attachments array<struct<type:string,ref:string,position:bigint,tokens:bigint>>"
)


def text_parts(text: str = "text"):
    """A text column as a message of one text part, whatever the text's length."""
    given = {"type": F.lit("text"), "text": F.coalesce(F.col(text), F.lit(""))}
    rest = {name: F.lit(None) for name in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(*(value.alias(name) for name, value in (given | rest).items()))).cast(PARTS)


def format_turns(messages: DataFrame, parts: str = "parts") -> DataFrame:
    """One formatted row per message: ``conv_id, turn, role, sequence, formatted, loss span, attachments``.

    ``parts`` is an array of typed parts (see ``PARTS``); null parts are an empty message, a null
    role an empty role. The loss span covers the content of assistant turns and is empty
    elsewhere. ``sequence`` tells rows of the same turn apart. Other columns are not read.
    """
    prepare(messages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            done = [format_message(row["role"], row["parts"] or []) for row in rows]
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "conv_id": row["conv_id"],
                        "turn": row["turn"],
                        "role": row["role"],
                        "sequence": row["sequence"],
                        "formatted": message.formatted,
                        "loss_start": message.loss_start,
                        "loss_end": message.loss_end,
                        "expanded_tokens": message.tokens,
                        "attachments": message.attachments,
                    }
                    for row, message in zip(rows, done)
                ],
                schema=_FORMATTED,
            )

    chosen = messages.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        "role",
        F.col(parts).alias("parts"),
        F.monotonically_increasing_id().alias("sequence"),
    )
    return chosen.mapInArrow(run, _FORMATTED_DDL)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class _Running:
    """Digests of a conversation that arrives turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        self.chars += len(formatted)
        learned = unescape(formatted[start:end])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())
        for role, text in parse_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation, from what ``format_turns`` wrote.

    The rows of a conversation are sorted by turn and read as a stream: only digests are
    held, whatever the length. Rows of the same turn are taken by role, then by content; a null
    turn comes first; rows without ``conv_id`` form one conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Running | None = None
        for batch in batches:
            done = []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "formatted", "loss_start", "loss_end")]
            for conv_id, formatted, start, end in zip(*columns):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Running(conv_id)
                current.add(formatted, start, end)
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.row()], schema=_DIGEST)

    return (
        turns.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "formatted")
        .drop("turn", "role")
        .mapInArrow(
            run,
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        )
    )
