"""Chat formatting from event logs: partition by conversation, sort, fold, render.

A log row is an event: conv_id, seq (order in the conversation), kind, message (number of the message in its
conversation), role and text. ``start`` opens a message with a role, ``delta`` adds text to it, ``edit``
replaces its text and drops every later message, ``regenerate`` empties it for new deltas and drops every
later message. Other kinds, and events on a message that was never started or was dropped, change nothing.

Rows are dealt and sorted by Spark; the fold holds one conversation at a time, which is also one row of the
result. Ties in seq are ordered by message, kind, role and text, so reruns agree. Null conv_ids form a
conversation; null text and role are empty.

The template is ``<s>role\\ntext</s>`` for each message. Inside role and text every backslash is doubled and a
backslash goes behind the first character of each control string, so none of them can be read as markup, and
dropping each escaping backslash gives back what was there. ``loss`` lists the [start, end) of the assistant's
escaped texts in code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EVENTS = "conv_id long, seq long, kind string, message long, role string, text string"
#: Strings that mean something to a chat model; no text may hold them bare.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
OPEN, CLOSE = "<s>", "</s>"
#: Code points in one streamed piece.
PIECE = 256

_CONTROLS = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROLS.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(messages: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans to learn from."""
    parts, loss, at = [], [], 0
    for role, text in messages:
        head, body = OPEN + escape(role).replace("\n", "\\\n") + "\n", escape(text)
        if role == learned:
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


class _Conversation:
    """Messages by number, each a role and pieces of text."""

    def __init__(self) -> None:
        self.messages: dict[int, tuple[str, list[str]]] = {}

    def fold(self, kind: str | None, message: int | None, role: str | None, text: str | None) -> None:
        if kind == "start":
            self.messages[message] = (role or "", [])
        elif message not in self.messages:
            return
        elif kind == "delta":
            self.messages[message][1].append(text or "")
        elif kind in ("edit", "regenerate"):
            later = False
            for m in list(self.messages):
                if later:
                    del self.messages[m]
                later |= m == message
            self.messages[message] = (self.messages[message][0], [text or ""] if kind == "edit" else [])

    def turns(self) -> list[tuple[str, str]]:
        return [(role, "".join(pieces)) for role, pieces in self.messages.values()]


_OUT = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
FORMATTED = "conv_id long, n_turns long, formatted string, loss array<struct<start: long, end: long>>"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, state = object(), None

    def row() -> dict:
        turns = state.turns()
        formatted, loss = render(turns)
        return {
            "conv_id": current, "n_turns": len(turns), "formatted": formatted,
            "loss": [{"start": a, "end": b} for a, b in loss],
        }

    for batch in batches:
        out, size = [], 0
        for conv, kind, message, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "message", "role", "text"))):
            if conv != current:
                if state:
                    out.append(row())
                    size += len(out[-1]["formatted"])
                current, state = conv, _Conversation()
                if size > 16_000_000:
                    yield pa.RecordBatch.from_pylist(out, _OUT)
                    out, size = [], 0
            state.fold(kind, message, role, text)
        if out:
            yield pa.RecordBatch.from_pylist(out, _OUT)
    if state:
        yield pa.RecordBatch.from_pylist([row()], _OUT)


def format_chats(events: DataFrame) -> DataFrame:
    """One formatted row per conversation of an event log (columns ``EVENTS``)."""
    order = ("conv_id", "seq", "message", "part", "kind", "role", "text")
    if "part" not in events.columns:
        events = events.withColumn("part", F.lit(0))
    return (
        events.select(*order).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_fold, FORMATTED)
    )


def log_of_turns(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """The event log that streams stored rows (conv_id, turn, role, text): a start, then deltas.

    Rows are in order of turn, role and text, nulls first, and each is a message of its own, equal rows
    included.
    """
    number = F.row_number().over(
        Window.partitionBy("conv_id").orderBy(
            F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
        )
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    starts = F.sequence(F.lit(0), F.ceil(F.length(text) / piece).cast("int"))
    return (
        turns.select("conv_id", "role", text.alias("text"), number.cast("long").alias("message"))
        .select("*", F.explode(starts).alias("part"))
        .select(
            "conv_id",
            F.col("message").alias("seq"),
            F.when(F.col("part") == 0, "start").otherwise("delta").alias("kind"),
            "message",
            F.when(F.col("part") == 0, F.col("role")).alias("role"),
            F.when(F.col("part") > 0, F.substring(F.col("text"), (F.col("part") - 1) * piece + 1, F.lit(piece))).alias("text"),
            "part",
        )
    )
