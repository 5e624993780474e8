"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says what stands before and after a turn of each role, which roles are trained
on, and which role may follow which.  Formatting a turn emits segments (text, loss flag).
Control strings inside texts are escaped reversibly, so the formatted text reads back to
the turns.  Turns are shuffled by conversation and sorted within partitions; a task walks
through its turns in order and keeps only the current conversation's state: the machine's
state, the sums and the running digests.  No conversation is gathered as a whole, however
long; the digests of one conversation are sequential, so one task reads its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\\"


@dataclass(frozen=True)
class Template:
    """``turns``: by role, the strings before and after its text; ``trained``: roles whose
    text carries loss; ``follows``: by role, the roles that may come next, ``start`` first.
    Roles that are not listed use the entry ``other``, where ``{role}`` is the role."""

    turns: dict[str, tuple[str, str]]
    trained: frozenset[str]
    follows: dict[str, frozenset[str]]
    ends: frozenset[str] = frozenset({"assistant"})
    controls: tuple[str, ...] = field(default=())

    def around(self, role: str) -> tuple[str, str]:
        if role in self.turns and role != "other":
            return self.turns[role]
        before, after = self.turns["other"]
        return before.replace("{role}", escape(role, self)), after


PLAIN = Template(
    turns={
        "system": ("[SYS]", "[/SYS]"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"),
        "other": ("[ROLE {role}]", "[/ROLE]"),
    },
    trained=frozenset({"assistant"}),
    follows={
        "start": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    controls=("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE ", "[/ROLE]"),
)


def escape(text: str, template: Template = PLAIN) -> str:
    """A mark before each mark, and before each first character of a control string: no
    control string is left whose first character is unmarked."""
    first = re.escape("".join(sorted({c[0] for c in template.controls})) + "]")
    return re.sub(f"([{first}{re.escape(MARK)}])", lambda m: MARK + m[1], text)


def unescape(text: str) -> str:
    return re.sub(re.escape(MARK) + "(.)", r"\1", text, flags=re.S)


def segments(role: str, text: str, template: Template = PLAIN) -> list[tuple[str, bool]]:
    """The segments of a turn, each with its loss flag."""
    before, after = template.around(role)
    return [(before, False), (escape(text, template), role in template.trained), (after, False)]


def read_back(formatted: str, template: Template = PLAIN) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted text; the inverse of joining segments."""
    body = rf"((?:[^{re.escape(MARK)}]|{re.escape(MARK)}.)*?)"
    forms = []
    for role in template.turns:
        before, after = template.turns[role]
        head = re.escape(before).replace(re.escape("{role}"), body)
        forms.append((role, re.compile(head + body + re.escape(after), re.S)))
    turns, at = [], 0
    while at < len(formatted):
        role, found = next((r, m) for r, p in forms if (m := p.match(formatted, at)))
        turns.append((unescape(found[1]) if role == "other" else role, unescape(found[found.lastindex])))
        at = found.end()
    return turns


def allowed(state: str, role: str, template: Template = PLAIN) -> bool:
    return role in template.follows.get(state, frozenset())


SEGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.int32()), ("text", pa.string()),
     ("loss", pa.bool_()), ("valid", pa.bool_())]
)
SEGMENTS_DDL = "conv_id long, turn long, segment int, text string, loss boolean, valid boolean"


def in_order(turns: DataFrame) -> DataFrame:
    """Turns of a conversation in one partition, by turn; ties by role and text."""
    return (
        turns.select(
            F.col("conv_id").cast("long"), F.col("turn").cast("long"),
            F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def format_turns(turns: DataFrame, template: Template = PLAIN) -> DataFrame:
    """Three segments per turn: conv_id, turn, segment (0 to 2), text, loss, valid.

    ``valid`` is false from the first turn on that the machine does not allow after the one
    before; such turns are formatted all the same.  Null text and null role: empty.  Null
    conv_id is one conversation; null turns come first.  Repeated rows are turns of their
    own.  An empty table gives an empty result; other columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, valid, begun = None, "start", True, False
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for c, t, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not begun or c != conv:
                    conv, state, valid, begun = c, "start", True, True
                valid = valid and allowed(state, role, template)
                state = role
                for k, (piece, loss) in enumerate(segments(role, text, template)):
                    for column, value in zip(out, (c, t, k, piece, loss, valid), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, SEGMENTS, strict=True)], schema=SEGMENTS)

    return in_order(turns).mapInArrow(run, SEGMENTS_DDL)


DIGESTS = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]
)
DIGESTS_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


class _Conversation:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.turns, self.loss, self.state, self.valid = hashlib.sha256(), hashlib.sha256(), "start", True

    def add(self, role: str, text: str, template: Template) -> None:
        """Formats a turn and reads the counts and digests back from what it emitted."""
        pieces = segments(role, text, template)
        formatted = "".join(p for p, _ in pieces)
        self.valid = self.valid and allowed(self.state, role, template)
        self.state = role
        self.chars += len(formatted)
        for got_role, got_text in read_back(formatted, template):
            self.n += 1
            self.turns.update(f"{got_role}\n{got_text}\n".encode())
        masked = "".join(unescape(p) for p, loss in pieces if loss)
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())

    def row(self, template: Template) -> tuple:
        done = self.valid and self.state in template.ends
        return (self.conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, done)


def digests(turns: DataFrame, template: Template = PLAIN) -> DataFrame:
    """One row per conversation, read back from its formatted text: turns, their digest,
    characters and digest of the text under the loss mask, formatted characters, and
    whether the machine accepts it (it must also end on a role of ``template.ends``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: _Conversation | None = None
        for batch in batches:
            rows = []
            for c, _, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if here is None or c != here.conv_id:
                    if here is not None:
                        rows.append(here.row(template))
                    here = _Conversation(c)
                here.add(role, text, template)
            yield _batch(rows)
        if here is not None:
            yield _batch([here.row(template)])

    return in_order(turns).mapInArrow(run, DIGESTS_DDL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(DIGESTS)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, DIGESTS, strict=True)], schema=DIGESTS)
