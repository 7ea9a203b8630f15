"""Chat formatting: a finite-state machine over roles emits text segments with loss flags from a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import together

@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles may follow which, where a conversation may end, and which texts carry loss.

    Escapes follow from the marks: in texts a backslash goes before each backslash, ``begin`` and ``end`` (without
    the white space around them), in roles before each backslash and first character of a mark. ``unescape``
    undoes both for every text and every template, so marks must not be empty, hold a backslash, or (``end``) overlap themselves.
    """

    begin: str = "### "
    after_role: str = ": "
    end: str = "</turn>\n"
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("user", "assistant")
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for mark in (self.begin, self.after_role, self.end):
            if not mark or "\\" in mark:
                raise ValueError(f"a mark must not be empty or hold a backslash: {mark!r}")
        for end in (self.end, self._core(self.end)):
            if any(end.startswith(end[i:]) for i in range(1, len(end))):
                raise ValueError(f"the end of a turn must not overlap itself: {end!r}")

    @staticmethod
    def _core(mark: str) -> str:
        return mark.strip() or mark

    def escape(self, text: str) -> str:
        text = re.sub("|".join(map(re.escape, ("\\", self._core(self.begin)))), lambda m: "\\" + m[0], text)
        return re.sub(r"\\.|" + re.escape(self._core(self.end)), lambda m: m[0] if m[0][0] == "\\" else "\\" + m[0], text, flags=re.S)

    def escape_role(self, role: str) -> str:
        first = {"\\", self.after_role[0], *(self._core(x)[0] for x in (self.begin, self.end))}
        return re.sub("|".join(map(re.escape, sorted(first))), lambda m: "\\" + m[0], role)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)


TEMPLATE = Template()
_SEGMENTS = "conv_id long, seq long, kind string, segment string, loss boolean, valid boolean, note string"


def _in_turn_order(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return together(rows, ["conv_id"], ["conv_id", "turn", "role", "text"])


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], per: int = 4096) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == per:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), types, strict=True)], names)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), types, strict=True)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_chat(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text, any other columns) -> segments (conv_id, seq, kind, segment, loss, valid, note), in order.

    A turn gives segments ``header``, ``text`` and ``end``; joined by seq they are the formatted conversation.
    After a conversation's last turn follows one ``verdict`` without text: valid, or the first breach of the
    turn order in note. Conversations in breach are formatted all the same. Turns go by turn, then role and
    text on ties (repeated rows are repeated turns); null turns come first, null role and text are empty, and
    rows without conv_id are one conversation. A conversation streams through one task turn by turn, whatever its length.
    """
    t = template

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            conv, seq, state, note, turns = None, 0, t.start, None, 0

            def verdict() -> tuple:
                end = note or (None if state in t.final else f"ends after {state}")
                return conv, seq, "verdict", "", False, end is None, end

            for conv_id, _, role, text in _rows(batches):
                if turns and conv_id != conv:
                    yield verdict()
                    seq, state, note, turns = 0, t.start, None, 0
                conv, turns = conv_id, turns + 1
                if note is None and role not in t.follows.get(state, ()):
                    note = f"turn {turns}: {role or 'no role'} after {state}"
                state = role
                for kind, segment in (("header", t.begin + t.escape_role(role) + t.after_role), ("text", t.escape(text)), ("end", t.end)):
                    yield conv, seq, kind, segment, kind == "text" and role in t.loss_roles, None, None
                    seq += 1
            if turns:
                yield verdict()

        yield from _batches(segments(), [x.split()[0] for x in _SEGMENTS.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string()])

    return _in_turn_order(conversations).mapInArrow(run, _SEGMENTS)


class TurnParser:
    """Reads role and text of each turn back from pieces of a formatted conversation."""

    def __init__(self, template: Template) -> None:
        self.t, self.buffer = template, ""
        self.end = re.compile(r"\\.|" + re.escape(template.end), re.S)
        self.colon = re.compile(r"\\.|" + re.escape(template.after_role), re.S)

    @staticmethod
    def _find(pattern: re.Pattern, text: str, at: int) -> re.Match | None:
        return next((m for m in pattern.finditer(text, at) if m[0][0] != "\\"), None)

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.buffer += piece
        while self.buffer and (colon := self._find(self.colon, self.buffer, len(self.t.begin))) and (end := self._find(self.end, self.buffer, colon.end())):
            yield self.t.unescape(self.buffer[len(self.t.begin) : colon.start()]), self.t.unescape(self.buffer[colon.end() : end.start()])
            self.buffer = self.buffer[end.end() :]


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of what ``format_chat`` wrote, parsed from its segments: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid), a row per conversation.

    ``segments`` may be saved and read again, in any order of rows and with other columns: they are sorted by conv_id and seq
    first. Rows without conv_id are one conversation; an empty table gives no rows, and rows after a conversation's last
    verdict none of their own. A segment given twice is read twice.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            fresh = True
            for conv, _, kind, segment, loss, valid, _ in _rows(batches):
                if fresh:
                    n = lost = chars = 0
                    all_turns, all_loss, parser, fresh = hashlib.sha256(), hashlib.sha256(), TurnParser(template), False
                chars += len(segment)
                if loss:
                    text = template.unescape(segment)
                    lost += len(text)
                    all_loss.update(text.encode())
                if kind != "text":
                    held = segment if kind == "header" else held + segment
                else:
                    held += segment
                if kind == "end":
                    for role, text in parser.feed(held):
                        n += 1
                        all_turns.update(f"{role}\n{text}\n".encode())
                if kind == "verdict":
                    yield conv, n, all_turns.hexdigest(), lost, all_loss.hexdigest(), chars, valid
                    fresh = True

        yield from _batches(digests(), [x.split()[0] for x in schema.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()])

    ordered = together(segments.select("conv_id", "seq", "kind", "segment", "loss", "valid", "note"), ["conv_id"], ["conv_id", "seq"])
    return ordered.mapInArrow(run, schema)
