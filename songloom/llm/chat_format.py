"""Chat formatting that is proved by parsing it back.

The grammar of a formatted conversation::

    conversation := turn*
    turn         := "### " role ":" newline text newline "</turn>" newline

``###`` and ``</turn>`` are control strings. Inside a text a run of backslashes before a control
string is one longer than in the source, so an active control string is one without a backslash
before it; role names escape ``\\``, ``:``, ``#``, ``<`` and newlines with letters. Each turn is first
rendered as it is and parsed; only where the parser does not give the source back is its content
escaped, and the result is parsed again.

A conversation is never held as a whole: the rows are sorted by conversation and turn, and each task
streams over them with running digests, so one very long conversation needs no more memory than a
short one. Null texts and roles count as empty. Turns that repeat a number are ordered by role and
text. Rows without a conversation id form one conversation of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import pick

OPEN, CLOSE = "### ", "</turn>"
TRAINED_ROLE = "assistant"
_CONTROL = re.compile(r"###|</turn>")
_ROLE_ESCAPES = {"\\": "\\\\", ":": "\\c", "#": "\\h", "<": "\\l", "\n": "\\n"}
_ROLE_PLAIN = {v[1]: k for k, v in _ROLE_ESCAPES.items()}


class GrammarError(ValueError):
    """The text is not a sequence of turns."""


def escape(text: str) -> str:
    """One more backslash before each control string; at its end, where it joins those that stand there."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    """One backslash less before each control string."""
    pieces, at = [], 0
    for found in _CONTROL.finditer(text):
        pieces.append(text[at : max(at, found.start() - 1)])
        at = found.start()
    return "".join([*pieces, text[at:]])


def render_turn(role: str, content: str) -> str:
    name = "".join(_ROLE_ESCAPES.get(c, c) for c in role)
    return f"{OPEN}{name}:\n{content}\n{CLOSE}\n"


def parse_turns(rendered: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; each character is looked at once."""
    turns, at = [], 0
    while at < len(rendered):
        colon = rendered.find(":\n", at)
        if not rendered.startswith(OPEN, at) or colon < 0:
            raise GrammarError("a turn has to begin here")
        role = re.sub(r"\\(.)", lambda m: _ROLE_PLAIN[m[1]], rendered[at + len(OPEN) : colon])
        begin = colon + 2
        hits = _CONTROL.finditer(rendered, begin)
        end = next((m for m in hits if m.start() == begin or rendered[m.start() - 1] != "\\"), None)
        if end is None or end[0] != CLOSE or end.start() <= begin or rendered[end.start() - 1] != "\n":
            raise GrammarError("the text of a turn does not end")
        turns.append((role, unescape(rendered[begin : end.start() - 1])))
        at = end.end() + 1
        if rendered[end.end() : at] != "\n":
            raise GrammarError("a turn has to end with a newline")
    return turns


def format_turn(role: str, text: str) -> str:
    """The turn as it is if it parses back to its source, else with its text escaped."""
    for content in (text, escape(text)):
        rendered = render_turn(role, content)
        try:
            if parse_turns(rendered) == [(role, text)]:
                return rendered
        except GrammarError:
            pass
    raise GrammarError("no rendering of this turn parses back")


def formatted_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, turn, role, text, rendered)``, in order within each task.

    All rows of a conversation are in one task, where they follow each other. The formatted
    conversation is its ``rendered`` pieces one after another.
    """
    rows = pick(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")})
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kept = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{n} {t}" for n, t in (kept | {"rendered": "string"}).items())
    return dealt.mapInArrow(_render, schema)


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch["role"].to_pylist(), batch["text"].to_pylist())
        rendered = pa.array([format_turn(role, text) for role, text in pairs], pa.string())
        yield batch.append_column("rendered", rendered)


@dataclass
class _Digest:
    conv_id: int | None
    n_turns: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss_chars: int = 0
    loss: object = field(default_factory=hashlib.sha256)
    formatted_chars: int = 0

    def add(self, rendered: str) -> None:
        """What the formatted text itself says, parsed and unescaped."""
        self.formatted_chars += len(rendered)
        for role, text in parse_turns(rendered):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == TRAINED_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for conv_id, rendered in zip(batch["conv_id"].to_pylist(), batch["rendered"].to_pylist()):
            if now is None or now.conv_id != conv_id:
                done += [now.row()] if now else []
                now = _Digest(conv_id)
            now.add(rendered)
        if done:
            yield _digest_batch(done)
            done = []
    if now:
        yield _digest_batch([now.row()])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in DIGEST_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def format_digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from ``formatted_turns`` by the parser.

    The loss mask covers the texts of the assistant's turns.
    """
    return formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "rendered").mapInArrow(_digest_rows, DIGEST_SCHEMA)
