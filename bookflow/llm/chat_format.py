r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as ``### Role: body </turn>`` and a line end. Each rendered turn is parsed
again by a deterministic parser; where the recovered turn isn't the source, or the body holds a control string (``###``
or ``</turn>``), the body's control strings get a backslash more before those they have, which the parser takes off,
and the turn is tried again. The parser ends a turn at the first ``</turn>`` without a backslash before it; the space
before that keeps a text's own last backslash apart. Turns end by themselves, so the parse of a conversation is that
of its turns.

Roles known to the template have names; any other role is written after ``=`` with backslashes before its special
characters. Null text and null role count as empty. Turns come by turn (null first), then role and text; repeated rows
are turns of their own; rows without a conv_id are one conversation; an empty table gives an empty result.

A conversation is put together as a stream in one task's order, never held: the digest of a hot conversation takes
time in proportion to it (a digest is sequential), but no memory.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
LEARNED = "assistant"
_OPEN, _CLOSE = "### ", " </turn>\n"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_ESCAPED = re.compile(r"\\(\\*)(###|</turn>)")
_HEAD = re.compile(r"### (?:=((?:[^\\:]|\\.)*)|([A-Z][a-z]*)): ", re.S)
_ROLES = {name: role for role, name in NAMES.items()}


def escape(text: str, level: int) -> str:
    """Level 0: as it is; 1: control strings with a backslash more."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text) if level else text


def render(role: str, text: str, level: int) -> tuple[str, int, int]:
    """The turn, and where its body begins and ends."""
    name = NAMES[role] if role in NAMES else "=" + re.sub(r"[\\:\n<#]", lambda m: "\\" + ("n" if m[0] == "\n" else m[0]), role)
    body = escape(text, level)
    head = f"{_OPEN}{name}: "
    return f"{head}{body}{_CLOSE}", len(head), len(head) + len(body)


def parse(formatted: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """The turn at ``at``: role, text, where the body begins and ends, and where the turn ends; None if there is none."""
    head = _HEAD.match(formatted, at)
    if not head:
        return None
    if head[2] is not None:
        role = _ROLES.get(head[2])
        if role is None:
            return None
    else:
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], head[1], flags=re.S)
    end = formatted.find("</turn>", head.end())
    while end >= 0 and formatted[end - 1] == "\\":
        end = formatted.find("</turn>", end + 1)
    if end <= head.end() - 1 or formatted[end - 1:end + 8] != _CLOSE:
        return None
    body = formatted[head.end():end - 1]
    return role, _ESCAPED.sub(r"\1\2", body), head.end(), end - 1, end + len(_CLOSE) - 1


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """The turn as rendered at the lowest level that the parser reads back, its body's place, and the level."""
    for level in (0, 1):
        out, begin, end = render(role, text, level)
        if parse(out) == (role, text, begin, end, len(out)) and (level or not _CONTROL.search(text)):
            return out, begin, end, level
    raise AssertionError("the grammar doesn't read its own output")


def _formatted(batches):
    for batch in batches:
        roles, texts = (["" if x is None else x for x in batch.column(i).to_pylist()] for i in (2, 3))
        out = [format_turn(r, t) for r, t in zip(roles, texts)]
        columns = [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int32()))]
        learned = pa.array([r == LEARNED for r in roles], pa.bool_())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *columns, learned],
                                         names=["conv_id", "turn", "role", "text", "formatted", "body_start", "body_end", "level", "loss"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """A row per turn: conv_id, turn, role, text, formatted, body_start, body_end, level (of escaping) and loss (the
    body is learned). A conversation's string is its turns' in order."""
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return own.mapInArrow(_formatted, "conv_id long, turn long, role string, text string, formatted string, "
                                      "body_start int, body_end int, level int, loss boolean")


class _Conversation:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv):
        self.conv, self.rest = conv, ""
        self.turns = self.loss = self.chars = 0
        self.sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def feed(self, formatted: str, learned: bool) -> None:
        self.rest += formatted
        self.chars += len(formatted)
        at = 0
        while turn := parse(self.rest, at):
            role, text, _, _, at = turn
            if learned != (role == LEARNED):
                raise ValueError("the loss mask isn't on the assistant's text")
            self.turns += 1
            self.sha.update(f"{role}\n{text}\n".encode())
            if learned:
                self.loss += len(text)
                self.loss_sha.update(text.encode())
        self.rest = self.rest[at:]

    def row(self):
        if self.rest:
            raise ValueError("the parser left a rest")
        return self.conv, self.turns, self.sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.chars


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read(batches):
    now, done = None, []
    for batch in batches:
        for conv, formatted, learned in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            now.feed(formatted, learned)
        if len(done) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _READ)], schema=_READ)
            done = []
    if now is not None:
        done.append(now.row())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _READ)], schema=_READ)


def read_back(turns: DataFrame) -> DataFrame:
    """A row per conversation of ``format_turns``, from the formatted text alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "formatted", "loss").mapInArrow(
        _read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
