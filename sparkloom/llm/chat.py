"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_chat`` turns rows (conversation, turn, role, text) into ordered text segments with a loss
flag each; ``read_chat`` parses the formatted text back. Both are one hash exchange on the
conversation, a spillable sort and a stream that holds one turn at a time, so a conversation of any
length needs bounded memory (its order, and the digests over it, are sequential by definition).

Defined cases: a null text is empty; a null role is the unknown role ``""``; null turns come first;
rows that tie on the turn are ordered by (role, text); repeated rows are turns of their own; a null
conversation id is a conversation; an empty table gives no rows. A turn whose role the machine does
not allow at its place is formatted all the same and marked ``allowed = false``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn, the roles under the loss, and the machine: state (last role) -> next roles."""

    open: str
    role_end: str
    close: str
    loss_roles: frozenset
    moves: dict
    accept: frozenset


CHATML = ChatTemplate(
    open="<|im_start|>", role_end="\n", close="<|im_end|>\n", loss_roles=frozenset({"assistant"}),
    moves={None: {"system", "user"}, "system": {"user"}, "user": {"assistant"},
           "assistant": {"user", "tool"}, "tool": {"assistant"}},
    accept=frozenset({"assistant"}))

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """One backslash more between every ``<`` and ``|`` that only backslashes part: no ``<|`` is left."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(keys[0]).sortWithinPartitions(*keys)


def _flush(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    rows.clear()
    return batch


def _arrow(id_type: T.DataType, fields: list) -> tuple[pa.Schema, T.StructType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv_id", id_type), *(T.StructField(n, t) for n, t in fields)])
    return to_arrow_schema(schema), schema


def format_chat(df: DataFrame, template: ChatTemplate = CHATML, conv: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Segments (conv_id, turn_no, part, segment, loss, allowed); part 0 opens, 1 is the text, 2 closes."""
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    arrow, schema = _arrow(rows.schema["conv_id"].dataType, [
        ("turn_no", T.LongType()), ("part", T.IntegerType()), ("segment", T.StringType()),
        ("loss", T.BooleanType()), ("allowed", T.BooleanType())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, n, out, size = object(), None, 0, [], 0
        for b in batches:
            for cid, who, said in zip(b["conv_id"].to_pylist(), b["role"].to_pylist(), b["text"].to_pylist(), strict=True):
                if cid != now:
                    now, state, n = cid, None, 0
                ok = who in template.moves.get(state, ())
                body = escape(said)
                out += [(cid, n, 0, template.open + _escape_role(who) + template.role_end, False, ok),
                        (cid, n, 1, body, who in template.loss_roles, ok), (cid, n, 2, template.close, False, ok)]
                state, n, size = who, n + 1, size + len(body) + 64
                if size > 4_000_000:
                    yield _flush(out, arrow)
                    size = 0
        if out:
            yield _flush(out, arrow)

    return _ordered(rows, "conv_id", "turn", "role", "text").mapInArrow(emit, schema)


def read_chat(segments: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Parse formatted segments back; one row per conversation with counts and digests.

    (conv_id, n_turns, turns_sha256 over ``role\\ntext\\n`` per turn, loss_chars, loss_sha256 of the
    unescaped text under the loss mask, formatted_chars, n_violations of the role machine).
    """
    arrow, schema = _arrow(segments.schema["conv_id"].dataType, [
        ("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()),
        ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()), ("n_violations", T.LongType())])
    shape = re.compile(re.escape(template.open) + "(?P<role>.*?)" + re.escape(template.role_end)
                       + "(?P<text>.*)" + re.escape(template.close), re.S)

    class Reader:
        def __init__(self, cid):
            self.cid, self.turns, self.loss = cid, hashlib.sha256(), hashlib.sha256()
            self.n = self.loss_chars = self.chars = self.bad = 0
            self.state, self.buffer, self.masked = None, [], []

        def feed(self, segment: str, loss: bool) -> None:
            self.chars += len(segment)
            self.buffer.append(segment)
            if loss:
                self.masked.append(segment)
            if not segment.endswith(template.close):
                return
            m = shape.fullmatch("".join(self.buffer))
            if m is None:
                raise ValueError(f"conversation {self.cid}: text does not follow the template")
            who, seen = _unescape_role(m["role"]), unescape("".join(self.masked))
            self.turns.update(f"{who}\n{unescape(m['text'])}\n".encode())
            self.loss.update(seen.encode())
            self.loss_chars += len(seen)
            self.bad += who not in template.moves.get(self.state, ())
            self.state, self.n, self.buffer, self.masked = who, self.n + 1, [], []

        def row(self) -> tuple:
            if self.buffer:
                raise ValueError(f"conversation {self.cid}: the last turn is not closed")
            return (self.cid, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                    self.bad + (self.state not in template.accept))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, out = None, []
        for b in batches:
            for cid, segment, loss in zip(b["conv_id"].to_pylist(), b["segment"].to_pylist(), b["loss"].to_pylist(), strict=True):
                if reader is None or reader.cid != cid:
                    out += [reader.row()] if reader else []
                    reader = Reader(cid)
                reader.feed(segment, loss)
            if len(out) > 5000:
                yield _flush(out, arrow)
        out += [reader.row()] if reader else []
        if out:
            yield _flush(out, arrow)

    return _ordered(segments, "conv_id", "turn_no", "part").mapInArrow(parse, schema)
