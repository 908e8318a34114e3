"""Chat formatting with a grammar round trip.

Grammar of the formatted text::

    conversation := turn*
    turn         := "### " role ":\\n" text "\\n</turn>\\n"

Roles escape backslash and line feed. In a text, a control string (``###`` or ``</turn>``) behind k > 0 backslashes
stands for the same string behind k - 1 of them; only a control string without a backslash is structure. Each turn is
rendered as it is, read back by the parser, and compared with its source; if they differ, its conflicting strings are
escaped and it is compared again, until both are identical.

Turns are sorted inside their conversation's partition and stream through one formatter and one parser, so that a task
holds one turn at a time, however long the conversation is. Digests are updated as turns are read back.

Defined cases: rows go by turn (null first), ties by role, then text; null roles and texts are empty; repeated rows are
turns of their own; rows with a null conv_id form one conversation; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.common import LONG, STRING

LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_END = re.compile(r"(?<!\\)</turn>\n")
_ROLE_OUT = {"\\": "\\\\", "\n": "\\n"}


def escaped(text: str) -> str:
    """One more backslash before each control string."""
    return _CONTROL.sub(r"\\\1\2", text)


def unescaped(text: str) -> str:
    """One backslash less before each control string that has any."""
    return _CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def _role_out(role: str) -> str:
    return re.sub(r"[\\\n]", lambda m: _ROLE_OUT[m[0]], role)


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def rendered(role: str, content: str) -> str:
    return f"### {_role_out(role)}:\n{content}\n</turn>\n"


class Parser:
    """Deterministic reader of formatted text, fed piece by piece. Yields (role, text, first and end character of the content)."""

    def __init__(self) -> None:
        self.rest, self.at = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        self.rest += piece
        while end := _END.search(self.rest):
            turn = self.rest[: end.start()]
            head = turn.find(":\n", 0, turn.find("\n") + 1)
            if not turn.startswith("### ") or head < 0 or not turn.endswith("\n") or len(turn) < head + 3:
                raise ValueError("not a turn")
            first, last = head + 2, len(turn) - 1
            yield _role_in(turn[4:head]), unescaped(turn[first:last]), self.at + first, self.at + last
            self.rest, self.at = self.rest[end.end() :], self.at + end.end()


def _reads_back(role: str, text: str, piece: str) -> bool:
    parser = Parser()
    try:
        turns = [t[:2] for t in parser.feed(piece)]
    except ValueError:
        return False
    return turns == [(role, text)] and not parser.rest


def formatted_turn(role: str, text: str) -> str:
    """The turn, escaped as far as it has to be."""
    content = text
    while not _reads_back(role, text, piece := rendered(role, content)):
        if content != text:
            raise ValueError("a turn does not survive formatting")
        content = escaped(content)
    return piece


def _sorted(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, piece, loss_start, loss_end): the formatted text in pieces of one turn.

    The pieces of a conversation, joined by position, are its text. The loss span counts characters of the piece, ends
    exclusive, and is null for turns without loss.
    """
    key = conversations.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", key), *(T.StructField(n, t) for n, t in (("position", LONG), ("piece", STRING), ("loss_start", LONG), ("loss_end", LONG)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, position = object(), 0
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                position, before = (position + 1 if key == before else 0), key
                piece = formatted_turn(role, text)
                loss = role == LOSS_ROLE
                (_, _, first, end), *_ = Parser().feed(piece)
                for values, value in zip(out, (position, piece, first if loss else None, end if loss else None), strict=True):
                    values.append(value)
            arrays = [batch.column("conv_id"), *(pa.array(v, k) for v, k in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return _sorted(conversations).mapInArrow(run, schema)


class _Digest:
    """What is read back from one conversation."""

    def __init__(self) -> None:
        self.parser = Parser()
        self.turns = self.loss = self.chars = 0
        self.all_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss_start: int | None, loss_end: int | None) -> None:
        self.chars += len(piece)
        for role, text, _, _ in self.parser.feed(piece):
            self.turns += 1
            self.all_sha.update(f"{role}\n{text}\n".encode())
        if loss_start is not None:  # what the mask covers, whatever the parser read
            text = unescaped(piece[loss_start:loss_end])
            self.loss += len(text)
            self.loss_sha.update(text.encode())

    def row(self) -> tuple:
        if self.parser.rest:
            raise ValueError("formatted text ends inside a turn")
        return self.turns, self.all_sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each formatted conversation, from its pieces as ``formatted`` leaves them: together and in order.

    Turns are what the parser reads; the loss text is what the loss mask covers, unescaped.
    """
    key = pieces.schema["conv_id"].dataType
    fields = (("n_turns", LONG), ("turns_sha256", STRING), ("loss_chars", LONG), ("loss_sha256", STRING), ("formatted_chars", LONG))
    schema = T.StructType([T.StructField("conv_id", key), *(T.StructField(n, t) for n, t in fields)])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, digest = None, None
        for batch in batches:
            keys, rows = [], []
            for key, *piece in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end")), strict=True):
                if digest is None or key != before:
                    if digest is not None:
                        keys.append(before)
                        rows.append(digest.row())
                    before, digest = key, _Digest()
                digest.feed(*piece)
            kind = batch.schema.field("conv_id").type
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=schema.names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([before], kind), *(pa.array([x], k) for x, k in zip(digest.row(), kinds, strict=True))], names=schema.names)

    return pieces.mapInArrow(run, schema)
