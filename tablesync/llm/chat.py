"""Chat formatting: a declarative template, a state machine over roles, segments with loss flags.

A template names, per role, the marks around a turn and whether its text counts for the loss,
and the roles that may follow in each state. The machine walks the turns of a conversation in order: a turn
whose role the state does not allow is a violation, which is counted and does not stop it. Each turn gives
segments of text, marks and contents apart, so the loss mask is a flag per segment; put one after
another they are the formatted conversation.

Control strings inside contents are broken by an escape after their first character, and the escape
itself is doubled, so no content holds a mark and the reader gets back what was written. A template
whose marks could arise where a mark and a content meet is refused.

The reader needs the formatted text alone for the turns, and the flags for the loss. Contents are
escaped before the exchange, where they lie. A conversation is then read as a stream of its rows in
order: its digest is a hash over all of it, which cannot be split, so its rows go to one task, which
holds one turn at a time, however long the conversation is.

Defined results: a null text is empty; a null role is the empty role; unknown roles are written with their
name and are violations; a null id is a conversation of its own; null turns come first, and rows of
one turn are ordered by role and text; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import carried, table

ESCAPE = "\\"

carried(__name__)


@dataclass(frozen=True)
class Turn:
    """The marks around the text of a role. At most one role has no opening mark."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``follows`` maps a state to the state that each allowed role leads to; ``start`` is the first state.

    Conversations may end in the states ``ends``. A role that the state does not allow leads to the
    state of its name. ``named`` are the marks of a turn whose role has no entry: before the
    role, between role and text, and after the text.
    """

    begin: str
    turns: dict[str, Turn]
    follows: dict[str, dict[str, str]]
    ends: frozenset[str]
    named: tuple[str, str, str]
    start: str = "start"
    escape: str = ESCAPE
    marks: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = {self.begin, *self.named, *chain.from_iterable((t.open, t.close) for t in self.turns.values())} - {""}
        object.__setattr__(self, "marks", tuple(sorted(marks, key=lambda m: (-len(m), m))))
        if "" in self.named or any(not t.close for t in self.turns.values()):
            raise ValueError("only an opening mark may be empty")
        if sum(not t.open for t in self.turns.values()) > 1 or len(
                {t.open for t in self.turns.values()} | {self.named[0]}) <= len(self.turns):
            raise ValueError("opening marks must tell the roles apart")
        for one in marks:
            if len(one) < 2 or self.escape in one:
                raise ValueError(f"mark {one!r} is shorter than two characters or has the escape in it")
            for other in marks:
                if one != other and one in other:
                    raise ValueError(f"mark {one!r} is part of {other!r}")
                if any(other.startswith(one[-k:]) for k in range(1, min(len(one), len(other)))):
                    raise ValueError(f"marks {one!r} and {other!r} can overlap")

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """The next state, and whether the state allows the role."""
        allowed = self.follows.get(state, {})
        return allowed.get(role, role), role in allowed

    def escaped(self, text: Column) -> Column:
        """The text as it is written: the escape doubled, every mark broken after its first character."""
        doubled = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        return F.regexp_replace(doubled, self.pattern(), "$0" + "\\" * 2 if self.escape == "\\" else "$0" + self.escape)

    def pattern(self) -> str:
        """Matches the first character of a mark."""
        return "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in self.marks)

    def plain(self, text: str) -> str:
        """What ``escaped`` was given."""
        if self.escape not in text:
            return text
        e = re.escape(self.escape)
        return re.sub(f"{e}({e}?)", r"\1", text)

    def segments(self, role: str, shown_role: str, text: str) -> list[tuple[str, bool]]:
        """A turn as (text, loss); contents are escaped already."""
        turn = self.turns.get(role)
        if turn is None:
            before, between, after = self.named
            return [(before + shown_role + between, False), (text, False), (after, False)]
        return [(turn.open, False), (text, turn.loss), (turn.close, False)]

    def read(self, text: str, at: int) -> tuple[str, str, int]:
        """The turn that starts at a place of a formatted text: role, content and where it ends."""
        before, between, after = self.named
        if text.startswith(before, at):
            middle, end = text.index(between, at), text.index(after, at)
            return (self.plain(text[at + len(before):middle]), self.plain(text[middle + len(between):end]),
                    end + len(after))
        role, turn = max(((r, t) for r, t in self.turns.items() if text.startswith(t.open, at)),
                         key=lambda found: len(found[1].open))
        start = at + len(turn.open)
        end = text.index(turn.close, start)
        return role, self.plain(text[start:end]), end + len(turn.close)


#: Turns of a user in brackets, the system's before the first, the assistant's up to the end mark.
INSTRUCT = Template(
    begin="<s>",
    turns={"system": Turn("<<SYS>>", "<</SYS>>"), "user": Turn("[INST]", "[/INST]"),
           "assistant": Turn("", "</s>", loss=True)},
    follows={"start": {"system": "system", "user": "user"}, "system": {"user": "user"},
             "user": {"assistant": "assistant"}, "assistant": {"user": "user"}},
    ends=frozenset({"assistant"}),
    named=("[ROLE]", "[TEXT]", "[/ROLE]"),
)

SEGMENTS = "conv_id long, seq long, text string, loss boolean, allowed boolean, state string, last boolean"
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("text", pa.string()), ("loss", pa.bool_()),
                       ("allowed", pa.bool_()), ("state", pa.string()), ("last", pa.bool_())])


def formatted(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """The segments of the conversations of ``rows`` (conv_id, turn, role, text), in order.

    ``seq`` counts the segments of a conversation; ``allowed`` tells whether the machine allowed the
    turn of a segment and ``state`` where it led; ``last`` marks the segment that ends a
    conversation. Each partition holds whole conversations, their segments in order.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
                        text.alias("plain"), template.escaped(role).alias("shown"), template.escaped(text).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "plain").drop("plain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, state, seq, begun, size = None, template.start, 0, False, 0
        for batch in batches:
            for conv, role, shown, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "shown", "text")]):
                if not begun or conv != now:
                    if begun:  # the mark of the end belongs to a segment, so it has one of its own
                        out.append((now, seq, "", False, True, state, True))
                    now, state, seq, begun = conv, template.start, 0, True
                    out.append((conv, seq, template.begin, False, True, state, False))
                    seq += 1
                state, allowed = template.step(state, role)
                for part, loss in template.segments(role, shown, text):
                    out.append((conv, seq, part, loss, allowed, state, False))
                    seq += 1
                size += len(text)
                if size > BATCH_CHARS or len(out) > BATCH_ROWS:
                    yield _batch(out)
                    out, size = [], 0
        if begun:
            out.append((now, seq, "", False, True, state, True))
        if out:
            yield _batch(out)

    return ordered.mapInArrow(run, SEGMENTS)


#: Characters and segments that a task holds before it passes them on.
BATCH_CHARS = 4 << 20
BATCH_ROWS = 20_000


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "violations long, complete boolean")
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                   ("violations", pa.int64()), ("complete", pa.bool_())])


class Reading:
    """A formatted conversation, read segment by segment; it holds what is not yet a whole turn."""

    def __init__(self, template: Template) -> None:
        self.template, self.pending, self.closes = template, [], self._closing(template)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.violations = 0
        self.begun = False

    @staticmethod
    def _closing(template: Template) -> frozenset[str]:
        return frozenset({template.named[2], *[t.close for t in template.turns.values()]})

    def add(self, text: str, loss: bool, allowed: bool) -> None:
        self.chars += len(text)
        if loss:
            content = self.template.plain(text)
            self.loss.update(content.encode())
            self.loss_chars += len(content)
        if text:
            self.pending.append(text)
        if text in self.closes:  # a content never is a mark, so this ends a turn
            self.violations += not allowed
            self._turn("".join(self.pending))
            self.pending = []

    def _turn(self, text: str) -> None:
        at = 0
        if not self.begun:
            if not text.startswith(self.template.begin):
                raise ValueError("a conversation without its first mark")
            at, self.begun = len(self.template.begin), True
        role, content, end = self.template.read(text, at)
        if end != len(text):
            raise ValueError("text after the end of a turn")
        self.turns.update(f"{role}\n{content}\n".encode())
        self.n_turns += 1

    def result(self, conv: int | None, state: str) -> tuple:
        return (conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.violations, state in self.template.ends)


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What the formatted conversations hold; ``segments`` are laid out as ``formatted`` gives them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading = None
        for batch in batches:
            out = []
            for conv, text, loss, allowed, state, last in zip(*[
                    batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "allowed", "state", "last")]):
                reading = reading or Reading(template)
                reading.add(text, loss, allowed)
                if last:
                    out.append(reading.result(conv, state))
                    reading = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _READ)], schema=_READ)

    return segments.mapInArrow(run, READ)


#: The conversation that quotes control strings, as the contract states it.
QUOTED = (-1, "</s>[INST] ok [/INST]")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = QUOTED
    quoted = spark.range(2).select(
        F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return read_back(formatted(rows.unionByName(quoted)))


_MARKS = "|".join(re.escape(m) for m in INSTRUCT.marks)
_OUTER = {role: len(t.open) + len(t.close) for role, t in INSTRUCT.turns.items()}

#: Escapes add one character per escape and per mark in a text; other roles than the three are named.
ORACLE = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{QUOTED[1]}' UNION ALL SELECT -1, 1, 'assistant', '{QUOTED[1]}'
), sized AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS final,
        length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '{_MARKS}'))
        + CASE role {' '.join(f"WHEN '{r}' THEN {n}" for r, n in _OUTER.items())}
            ELSE {sum(map(len, INSTRUCT.named))} + length(role) END AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
        AS loss_sha256,
    ({len(INSTRUCT.begin)} + sum(chars))::BIGINT AS formatted_chars,
    count(*) FILTER (NOT CASE role WHEN 'system' THEN before IS NULL
        WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
        WHEN 'assistant' THEN before IS NOT NULL AND before = 'user' ELSE false END) AS violations,
    bool_or(final AND role = 'assistant') AS complete
FROM sized GROUP BY conv_id
"""
