"""Chat formatting with typed content parts.

A turn's content is a list of parts.  A visitor flattens them in order: text
is escaped, images, audio and documents become placeholders; for each of these
it records where the placeholder stands, what it refers to and how many tokens
a model would expand it to.  A turn is written as

    <|turn|>role<|text|>content<|end|>newline

and control strings inside roles and texts are escaped reversibly: every
backslash is doubled and one is put after the first character of a control
string.  A loss mask covers the content of the trained roles.

Conversations are streamed in order (partitioned by conversation, sorted by
turn), so one that holds a third of all rows needs no more memory than a
short one.

Results: a null text is the empty text, a null role the empty role; rows of
one turn number are ordered by role and text; a null conversation id is a
conversation of its own; parts of unknown kind become a placeholder without
tokens, null parts nothing; an empty table gives an empty table.
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

from zonescope.llm.common import ship, slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings that texts must not smuggle in as marks.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")

IMAGE_PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 512

PART = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
ATTACHMENT = pa.struct([("kind", pa.string()), ("uri", pa.string()), ("place", pa.int32()), ("tokens", pa.int64())])


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one turn."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, math.ceil((part.get(side) or 0) / IMAGE_PATCH)) for side in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part.get("pages") or 0) * DOCUMENT_TOKENS_PER_PAGE)

    def visit_unknown(self, part: dict) -> None:
        self.attach("unknown", part, 0)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        place = sum(map(len, self.pieces))
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "place": place, "tokens": tokens})
        self.pieces.append(f"<|{kind}:{len(self.attachments) - 1}|>")


SCHEMA = "conv_id long, turn long, formatted string, start long, loss_start int, loss_length int, attachments array<struct<kind:string,uri:string,place:int,tokens:bigint>>, expanded_tokens long"
_NAMES = ["conv_id", "turn", "formatted", "start", "loss_start", "loss_length", "attachments", "expanded_tokens"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.list_(ATTACHMENT), pa.int64()]


def _format(trained: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, start = object(), 0
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for row in batch.to_pylist():
                    if row["conv_id"] != current:
                        current, start = row["conv_id"], 0
                    visitor = Flattener()
                    for part in row["parts"] or ():
                        if part is not None:
                            visitor.visit(part)
                    role = row["role"] or ""
                    head, content = TURN + escape(role) + TEXT, "".join(visitor.pieces)
                    formatted = head + content + END
                    masked = len(content) if role in trained else 0
                    rows.append((row["conv_id"], row["turn"], formatted, start, len(head), masked, visitor.attachments, sum(a["tokens"] for a in visitor.attachments)))
                    start += len(formatted)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)

    return run


def format_conversations(df: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn, conversations one after another in each partition, turns in order.

    ``formatted`` is the turn as written, ``start`` its place (code points) in
    the conversation; the loss mask is ``loss_length`` code points from
    ``loss_start`` of ``formatted``; ``attachments`` have places within the
    content.  Content is taken from a column ``parts`` (see PART) if there is
    one, else from ``text``.
    """
    ship(df.sparkSession)
    if "parts" in df.columns:
        parts = F.col("parts").cast(PART)
    else:
        empty = [F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
        parts = F.array(F.struct(F.lit("text").alias("kind"), F.col("text").cast("string").alias("text"), *empty))
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), parts.alias("parts"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")
    return ordered.mapInArrow(_format(frozenset(trained)), SCHEMA)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and content of a formatted turn, unescaped; placeholders stay."""
    if not formatted.startswith(TURN) or not formatted.endswith(END):
        raise ValueError("not a formatted turn")
    role, mark, content = formatted[len(TURN) : -len(END)].partition(TEXT)
    if not mark:
        raise ValueError("a turn without its text mark")
    return unescape(role), unescape(content)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current, state, done = object(), None, []

    def close() -> None:
        if state is not None:
            done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for conv, formatted, a, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_length")), strict=True):
            if conv != current:
                close()
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_turn(formatted)
            masked = unescape(formatted[a : a + n])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2] += len(masked)
            state[3].update(masked.encode())
            state[4] += len(formatted)
        if done:
            yield out()
            done = []
    close()
    if done:
        yield out()


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted turns back gives, per conversation.  Takes the rows in the order of :func:`format_conversations`."""
    return formatted.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
