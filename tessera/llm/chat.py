"""Chat formatting with typed content parts.

A message is a role and a list of parts. A visitor flattens the parts in order: text is
escaped, and an image, audio or document part becomes a numbered placeholder, with its
reference, its place in the formatted text and the number of tokens it expands to.

Template, one row a turn: ``<turn role="ROLE">BODY</turn>`` and a line end. Inside BODY and ROLE
a backslash stands before every backslash, ``<`` and double quote of the input, so control
strings in a text never look like the template's own, and reading back restores every
character. The loss mask of a turn is a range of the formatted text: the body of an
assistant turn.

Turns of a conversation are brought together and sorted by Spark and then flow through the
task in batches: neither formatting nor the digests hold a whole conversation, so a very
long one costs time in its task but no memory.

Results for special rows: a null or empty text is an empty body; a null role is the empty
role; a null conversation id is one conversation; turns are ordered by turn number (null
first), then role, then text; repeated rows are separate turns; an unknown part type is a
document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "array<struct<kind:string,ref:string,at:bigint,tokens:bigint>>"
PATCH = 14
AUDIO_TOKENS_A_SECOND = 25
TOKENS_A_PAGE = 576
TRAINED_ROLE = "assistant"

_SPECIAL = re.compile(r'[\\<"]')
_ESCAPED = re.compile(r'\\([\\<"])')
_TURN = re.compile(r'<turn role="((?:[^\\"]|\\.)*)">(.*)</turn>\n', re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visitor over the parts of one message."""

    def __init__(self, at: int, number: int):
        self.pieces, self.at, self.number, self.attachments, self.tokens = [], at, number, [], 0

    def add(self, piece: str, tokens: int) -> None:
        self.pieces.append(piece)
        self.at += len(piece)
        self.tokens += tokens

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.add(escape(text), len(text.split()))

    def visit_image(self, part: dict) -> None:
        across, down = (max(1, math.ceil((part.get(n) or PATCH) / PATCH)) for n in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part.get("pages") or 1) * TOKENS_A_PAGE)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.number += 1
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "at": self.at, "tokens": tokens})
        self.add(f"<{kind} {self.number}/>", tokens)


def format_turn(role: str, parts: list[dict], number: int = 0) -> tuple[str, int, int, Flattener]:
    """The formatted turn, its loss range and the visitor that holds what else was recorded."""
    head = f'<turn role="{escape(role)}">'
    v = Flattener(len(head), number)
    for part in parts:
        v.visit(part)
    start = len(head) if role == TRAINED_ROLE else v.at
    return f"{head}{''.join(v.pieces)}</turn>\n", start, v.at, v


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn without attachments."""
    m = _TURN.fullmatch(formatted)
    if m is None:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def format_conversations(messages: DataFrame) -> DataFrame:
    """Format ``messages(conv_id, turn, role, text)`` or ``(conv_id, turn, role, parts)``.

    Returns one row a turn, turns of a conversation in order and in one partition:
    ``conv_id, position, formatted, loss_start, loss_end, attachments, tokens``.
    """
    if "parts" not in messages.columns:
        part = F.named_struct(*[x for f in _part_fields() for x in (F.lit(f[0]), {"type": F.lit("text"), "text": F.coalesce("text", F.lit(""))}.get(f[0], F.lit(None)).cast(f[1]))])
        messages = messages.select("conv_id", "turn", "role", F.array(part).alias("parts"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")).alias("parts"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")
    id_type = messages.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, position, number = object(), 0, 0
        for batch in batches:
            ids, roles, parts = (batch.column(n).to_pylist() for n in ("conv_id", "role", "parts"))
            out = [[] for _ in range(6)]
            for conv, role, content in zip(ids, roles, parts):
                if conv != at:
                    at, position, number = conv, 0, 0
                formatted, start, end, v = format_turn(role, [p for p in content if p], number)
                number = v.number
                for column, value in zip(out, (position, formatted, start, end, v.attachments, v.tokens)):
                    column.append(value)
                position += 1
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                names=["conv_id", "position", "formatted", "loss_start", "loss_end", "attachments", "tokens"],
            )

    return rows.mapInArrow(run, f"conv_id {id_type}, position long, formatted string, loss_start long, loss_end long, attachments {ATTACHMENT}, tokens long")


def _part_fields() -> list[list[str]]:
    return [f.split(":") for f in PART[len("struct<") : -1].split(",")]


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns back; one row a conversation.

    Takes the rows of :func:`format_conversations` in their order.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state = None

        def batch_of(rows: list[list], kind: pa.DataType) -> pa.RecordBatch:
            done = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in rows]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t or kind) for i, t in enumerate(kinds)], names=names)

        for batch in batches:
            done, kind = [], batch.column("conv_id").type
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "position", "formatted", "loss_start", "loss_end"))
            for conv, position, turn, start, end in zip(*columns):
                if position == 0:
                    if state:
                        done.append(state)
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if state is None or state[0] != conv or state[1] != position:
                    raise ValueError("turns of a conversation are not in order")
                role, text = read_turn(turn)
                loss = unescape(turn[start:end])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(turn)
            yield batch_of(done, kind)
        if state:
            yield batch_of([state], kind)

    return formatted.mapInArrow(run, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
