"""Chat formatting with typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document. A visitor writes text escaped and every
other part as a placeholder, and records attachment references and the tokens that placeholders expand to. The
template is line based, ``<|im_start|>role`` newline, content, ``<|im_end|>`` newline. Control strings inside texts are
escaped by a backslash after the angle bracket, so nothing a text says can end a turn, and reading back gives the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens that a placeholder stands for, by kind of part; a part may name its own.
TOKENS = {"image": 576, "audio": 250, "document": 1024}
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_PLACE = re.compile(r"<\|(image|audio|document)_(\d+)\|>")
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _role(text: str) -> str:
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


@dataclass
class Formatted:
    """What the visitor has written: pieces, loss spans in code points, attachments in order of their placeholders."""

    pieces: list[str] = field(default_factory=list)
    size: int = 0
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[str, str, int]] = field(default_factory=list)

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def visit_turn(self, role: str, parts: list[tuple[str, str, int | None]]) -> None:
        self._put(f"{START}{_role(role)}\n")
        begin = self.size
        # neighbouring texts are escaped as one, or a control string cut over two of them would pass
        joined: list[tuple[str, str, int | None]] = []
        for kind, value, tokens in parts:
            if kind == "text" and joined and joined[-1][0] == "text":
                joined[-1] = kind, joined[-1][1] + value, None
            else:
                joined.append((kind, value, tokens))
        for kind, value, tokens in joined:
            getattr(self, f"visit_{kind}", self.visit_unknown)(kind, value, tokens)
        if role == LOSS_ROLE:
            self.loss.append((begin, self.size))
        self._put(f"{END}\n")

    def visit_text(self, kind: str, value: str, tokens: int | None) -> None:
        self._put(escape(value))

    def visit_attachment(self, kind: str, value: str, tokens: int | None) -> None:
        self._put(f"<|{kind}_{len(self.attachments)}|>")
        self.attachments.append((kind, value, TOKENS[kind] if tokens is None else tokens))

    visit_image = visit_audio = visit_document = visit_attachment

    def visit_unknown(self, kind: str, value: str, tokens: int | None) -> None:
        raise ValueError(f"content part of unknown type {kind!r}")


def read_back(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of the turns of a formatted conversation; attachments by their number."""
    turns = []
    for m in _TURN.finditer(formatted):
        parts, at = [], 0
        for p in _PLACE.finditer(m[2]):
            if p.start() > at:
                parts.append(("text", unescape(m[2][at : p.start()])))
            parts.append((p[1], p[2]))
            at = p.end()
        if at < len(m[2]) or not parts:
            parts.append(("text", unescape(m[2][at:])))
        turns.append((_unrole(m[1]), parts))
    return turns


PART = "struct<type:string,value:string,tokens:int>"
_OUT = "conv_id long, formatted string, loss array<struct<start:int,end:int>>, attachments array<struct<type:string,reference:string,tokens:int>>, expanded_tokens long"


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """A row per conversation: ``conv_id, formatted, loss, attachments, expanded_tokens``.

    Turns come in order of the turn number, equal or null ones (null first) by role and text. ``parts_col`` may hold an
    array of typed parts; without it, or where it is null, the text is the only part. Null texts, roles and part values
    are empty; neighbouring text parts become one; a part of unknown type is an error. Rows are dealt by conversation,
    sorted and streamed, so no conversation is gathered in a frame, but one is written by one task; rows without a
    conversation id form one conversation with a null id. Repeated rows are turns of their own; an empty table gives no
    rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = F.array(F.struct(F.lit("text").alias("type"), text.alias("value"), F.lit(None).cast("int").alias("tokens")))
    if parts_col:
        parts = F.coalesce(F.col(parts_col).cast(f"array<{PART}>"), parts)
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text"), parts.alias("parts")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "parts")

    def done(conv: int | None, out: Formatted) -> tuple:
        attached = [{"type": k, "reference": v, "tokens": n} for k, v, n in out.attachments]
        return conv, "".join(out.pieces), [{"start": x, "end": y} for x, y in out.loss], attached, sum(n for _, _, n in out.attachments)

    def batch(ready: list[tuple]) -> pa.RecordBatch:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        attached = pa.list_(pa.struct([("type", pa.string()), ("reference", pa.string()), ("tokens", pa.int32())]))
        kinds = (pa.int64(), pa.string(), span, attached, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*ready), kinds)], names=["conv_id", "formatted", "loss", "attachments", "expanded_tokens"])

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, None
        for b in batches:
            ready = []
            for conv, role, content in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or conv != now:
                    if out is not None:
                        ready.append(done(now, out))
                    now, out = conv, Formatted()
                out.visit_turn(role, [(p["type"], p["value"] or "", p["tokens"]) for p in content if p is not None])
            if ready:
                yield batch(ready)
        if out is not None:
            yield batch([done(now, out)])

    return rows.mapInArrow(formatted, _OUT)


def digests(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back and summarise what they say and what is under the loss mask."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, text, loss in zip(*(c.to_pylist() for c in b.columns)):
                turns = [(role, "".join(v for k, v in parts if k == "text")) for role, parts in read_back(text)]
                under = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows), kinds)], names=names)

    return chats.select("conv_id", "formatted", "loss").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
