"""Chat formatting: a state machine over roles and a declarative template.

A template names the roles, which of them may follow which, the strings around a turn
and the roles whose texts a model should learn. A conversation becomes segments: text
with a loss flag, three per turn. Characters of the control strings are written as
escapes inside texts and unknown role names, so no text can end its turn or open one,
and reading back gives every text as it was.

Rows are dealt by conversation, sorted and streamed, and a task holds one turn at a
time, so a conversation may be larger than memory.

Defined cases: turns follow ``turn``, then role, then text; a null role is an empty
one, a null text an empty text; rows without conv_id are one conversation without id;
turns after one that the machine does not allow are formatted but not valid.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docstrata.llm.tables import pick


@dataclass(frozen=True)
class Template:
    """How turns are written; ``follows`` maps a state (the last role, or "" at the
    start) to the roles that may come next."""

    opening: str = "### {label}: "
    closing: str = " </turn>\n"
    labels: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    learned: tuple[str, ...] = ("assistant",)
    escapes: dict[str, str] = field(
        default_factory=lambda: {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
    )
    unknown: str = "?"

    def escape(self, text: str, also: str = "") -> str:
        """Without control characters; ``:`` only matters in labels."""
        chars = [c for c in self.escapes if c != ":" or c in also]
        return re.sub("[" + re.escape("".join(chars)) + "]", lambda m: self.escapes[m[0]], text)

    def unescape(self, text: str) -> str:
        plain = {v: k for k, v in self.escapes.items()}
        return re.sub(r"\\.", lambda m: plain[m[0]], text)

    def head(self, role: str) -> str:
        label = self.labels.get(role)
        if label is None:
            label = self.unknown + self.escape(role, ":")
        return self.opening.format(label=label)

    def role(self, head: str) -> str:
        before, after = self.opening.split("{label}")
        label = head[len(before) : len(head) - len(after)]
        if label.startswith(self.unknown):
            return self.unescape(label[len(self.unknown) :])
        return {v: k for k, v in self.labels.items()}[label]


_SEGMENT = "conv_id bigint, position bigint, text string, loss boolean, valid boolean"
_DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, valid boolean"
)


def format_conversations(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments (conv_id, position, text, loss, valid) of conversations (conv_id, turn,
    role, text), each conversation in order within one partition."""
    template = template or Template()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = formatted
        state, valid, position = "", True, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True
            ):
                if current is formatted or conv != current:
                    current, state, valid, position = conv, "", True, 0
                valid = valid and role in template.follows.get(state, ())
                state = role
                rows.append((conv, position, template.head(role), False, valid))
                rows.append((conv, position + 1, template.escape(text), role in template.learned, valid))
                rows.append((conv, position + 2, template.closing, False, valid))
                position += 3
            yield _batch(rows, _SEGMENT)

    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(formatted, _SEGMENT)


def read_digests(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """Reads formatted segments back and digests each conversation: its turns (role,
    line feed, text, line feed) and the unescaped text under the loss mask."""
    template = template or Template()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Reader | None = None
        for batch in batches:
            done = []
            for conv, text, loss, valid in zip(
                *(batch[c].to_pylist() for c in ("conv_id", "text", "loss", "valid")), strict=True
            ):
                if current is None or current.conv != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Reader(conv, template)
                current.add(text, loss, valid)
            yield _batch(done, _DIGEST)
        if current is not None:
            yield _batch([current.row()], _DIGEST)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(digests, _DIGEST)


class _Reader:
    """Parses the formatted text of one conversation by the template and digests its turns.

    Only the text and the loss mask count, not where segments end: a turn runs from the
    opening with its label to the closing, which no text can hold.
    """

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template = conv, template
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.count = self.chars = self.loss_chars = 0
        self.inside, self.valid = False, True
        self.text, self.mask = "", []  # what is not parsed yet; the mask as (length, loss)
        self.before, self.after = template.opening.split("{label}")

    def add(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid = self.valid and valid
        self.text += text
        self.mask.append((len(text), loss))
        while self._parse():
            pass

    def _parse(self) -> bool:
        if self.inside:
            end = self.text.find(self.template.closing)
            if end < 0:
                return False
            body, learned = self._take(end)
            plain = self.template.unescape(body)
            self.turns.update(f"{plain}\n".encode())
            if learned:
                learned = self.template.unescape(learned)
                self.learned.update(learned.encode())
                self.loss_chars += len(learned)
            self._take(len(self.template.closing))
        else:
            end = self.text.find(self.after, len(self.before))
            if end < 0:
                return False
            head, _ = self._take(end + len(self.after))
            self.turns.update(f"{self.template.role(head)}\n".encode())
            self.count += 1
        self.inside = not self.inside
        return True

    def _take(self, size: int) -> tuple[str, str]:
        """The next characters, and those of them under the loss mask."""
        taken, learned, at = self.text[:size], [], 0
        self.text = self.text[size:]
        while at < size:
            length, loss = self.mask.pop(0)
            used = min(length, size - at)
            if loss:
                learned.append(taken[at : at + used])
            if used < length:
                self.mask.insert(0, (length - used, loss))
            at += used
        return taken, "".join(learned)

    def row(self) -> tuple:
        if self.inside or self.text:
            raise ValueError(f"conversation {self.conv}: the formatted text ends within a turn")
        digests = self.turns.hexdigest(), self.loss_chars, self.learned.hexdigest()
        return self.conv, self.count, *digests, self.chars, self.valid


_KINDS = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], list(names)
    )
