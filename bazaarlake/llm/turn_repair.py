"""Cheapest repair of conversations whose turns are blank, repeated, missing or misplaced.

A repaired conversation has a system turn or none, then pairs of a user's and an
assistant's turn; it may also be empty. Turns are kept, given another role, deleted or
inserted at a cost. The state of the dynamic programme is the role of the last turn
kept, so the best way on from a turn takes four costs and one choice for each state.

Rows are repartitioned by conversation and sorted by turn within the partitions, and
stream through a task twice. The first stream runs from the last turn to the first,
carries the four costs from one Arrow batch to the next and puts out the four choices of
each turn in one byte; every ``BLOCK_TURNS`` of them leave as a row, so that what a giant
conversation needs is spilled by Spark and never held by the task. The second stream runs
from the first turn to the last and meets each block of choices just before its first
turn; following them takes the state alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from bazaarlake.session import written

# Costs of the edits; a truncated turn that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Choices of so many turns are one row.
BLOCK_TURNS = 65_536

# Edits in ASCII order, so that the least code of the cheapest is the one wanted.
LETTERS = "DIKR"
_D, _I, _K, _R = range(4)

# States: nothing yet, after the system turn, after a user's, after an assistant's turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
# The state after a turn with the role that is due, and that role.
_DUE = (_USER, _USER, _ASSISTANT, _USER)
_DUE_ROLE = ("user", "user", "assistant", "user")
# The state after a kept turn by its initial, where it may be kept.
_KEPT = {
    "s": {_START: _SYSTEM},
    "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER},
    "a": {_USER: _ASSISTANT},
}
# The cheapest way to the end when no turn is left.
_END = (0, 2 * INSERT, INSERT, 0)

# First fault of a turn.
SOUND, BLANK, DUPLICATE, IS_TRUNCATED = range(4)
_LEGAL = {"su", "ua", "au"}


@lru_cache(maxsize=100_000)
def _choose(after: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Costs from before a turn to the end, by state, and the four choices there.

    ``after`` holds the costs from behind the turn to the end. Choices take two bits each.
    """
    extra = TRUNCATED if fault == IS_TRUNCATED else 0
    stays = _KEPT.get(initial, {})
    best = []
    for state in range(4):
        ways = [(DELETE + after[state], _D)]
        if fault not in (BLANK, DUPLICATE):
            if state in stays:
                ways.append((extra + after[stays[state]], _K))
            ways.append((REROLE + extra + after[_DUE[state]], _R))
        best.append(min(ways))
    # An inserted turn first. Two in a row lead back to the same state, so it pays once,
    # and the states at the start come to the later ones only after those are settled.
    plain = list(best)
    for state in (_USER, _ASSISTANT):
        best[state] = min(plain[state], (INSERT + plain[_DUE[state]][0], _I))
    for state in (_START, _SYSTEM):
        best[state] = min(plain[state], (INSERT + best[_DUE[state]][0], _I))
    choices = sum(code << 2 * state for state, (_, code) in enumerate(best))
    return tuple(cost for cost, _ in best), choices


class _Block:
    """Choices of a run of turns, gathered from its last turn to its first."""

    def __init__(self) -> None:
        self.choices = bytearray()
        self.number = 0

    def row(self, conversation: Any, first: tuple) -> tuple:
        self.choices.reverse()
        out = (conversation, *first, self.number, bytes(self.choices))
        self.number += 1
        self.choices = bytearray()
        return out


def _choices(schema: pa.Schema, block_turns: int):
    """Rows from the last turn to the first; out come blocks of choices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conversation, costs, block, first = False, None, _END, _Block(), ()
        for batch in batches:
            out = []
            cells = zip(*(batch.column(name).to_pylist() for name in _TURN), strict=True)
            for conv, turn, role, text, fault in cells:
                if not started or conv != conversation:
                    if block.choices:
                        out.append(block.row(conversation, first))
                    started, conversation, costs, block = True, conv, _END, _Block()
                elif len(block.choices) >= block_turns:
                    out.append(block.row(conversation, first))
                # Only differences matter for the choices, and they stay small.
                least = min(costs)
                costs, choices = _choose(tuple(c - least for c in costs), role[:1], fault)
                block.choices.append(choices)
                first = (turn, role, text)
            if out:
                yield _batch(out, schema)
        if block.choices:
            yield _batch([block.row(conversation, first)], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


@dataclass
class _Walk:
    """One conversation on its way from the first turn to the last."""

    conversation: Any
    state: int = _START
    choices: bytearray = field(default_factory=bytearray)
    used: int = 0
    turns: list = field(default_factory=lambda: [None, None, 0])  # first, last, distinct
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    before: str | None = None
    cost: int = 0
    audit: bytearray = field(default_factory=bytearray)
    digest: Any = field(default_factory=hashlib.sha256)
    said: bool = False

    def take(self, block: bytes) -> None:
        self.choices = self.choices[self.used :] + block
        self.used = 0

    def _edit(self, code: int, turn: int | None, role: str, text: str) -> tuple:
        """Note an edit; a row of the edited conversation."""
        number = len(self.audit)
        self.audit.append(ord(LETTERS[code]))
        if code != _D:
            self.digest.update(f"{chr(10) * self.said}{role}:{text}".encode())
            self.said = True
        return self.conversation, number, LETTERS[code], turn, role, text

    def _insert(self) -> tuple:
        role = _DUE_ROLE[self.state]
        self.state = _DUE[self.state]
        self.cost += INSERT
        return self._edit(_I, None, role, "")

    def step(self, turn: int | None, role: str, text: str, fault: int) -> Iterator[tuple]:
        """The edits up to and with this turn."""
        if turn is not None:
            if self.turns[2] == 0:
                self.turns[0] = turn
            if self.turns[2] == 0 or turn != self.turns[1]:
                self.turns[2] += 1
            self.turns[1] = turn
        self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in _LEGAL
        self.before = initial
        choices = self.choices[self.used]
        self.used += 1
        while (code := choices >> 2 * self.state & 3) == _I:
            yield self._insert()
        if code == _D:
            self.cost += DELETE
        else:
            self.cost += TRUNCATED if fault == IS_TRUNCATED else 0
            if code == _R:
                self.cost += REROLE
                role, self.state = _DUE_ROLE[self.state], _DUE[self.state]
            else:
                self.state = _KEPT[initial][self.state]
        yield self._edit(code, turn, role, text)

    def end(self) -> Iterator[tuple]:
        while self.state in (_SYSTEM, _USER):
            yield self._insert()

    def report(self) -> tuple:
        first, last, distinct = self.turns
        gaps = last - first + 1 - distinct if distinct else 0
        return (
            self.conversation, gaps, *self.faults[1:], self.illegal, self.cost,
            self.audit.decode(), self.digest.hexdigest(),
        )


_TURN = ("conv", "turn", "role", "text", "fault")
_MARK, _CHOICES, _ROW = range(3)


def _follow(schema: pa.Schema, edits: bool):
    """Rows from the first turn to the last, among them blocks of choices; out come the
    rows of the edited conversations, or one report for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            out = []
            names = (*_TURN, "kind", "choices")
            cells = zip(*(batch.column(name).to_pylist() for name in names), strict=True)
            for conv, turn, role, text, fault, kind, choices in cells:
                if walk is None or conv != walk.conversation:
                    if walk is not None:
                        out += _ended(walk, edits)
                    walk = _Walk(conv)
                if kind == _CHOICES:
                    walk.take(choices)
                elif kind == _ROW:
                    for edit in walk.step(turn, role, text, fault):
                        if edits:
                            out.append(edit)
            if out:
                yield _batch(out, schema)
        if walk is not None and (out := _ended(walk, edits)):
            yield _batch(out, schema)

    return run


def _ended(walk: _Walk, edits: bool) -> list[tuple]:
    last = list(walk.end())
    return last if edits else [walk.report()]


def turns_with_faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text) with ``fault``, the first fault of each row.

    Partitioned by conversation: one shuffle serves this and the streams.
    """
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    same = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    return rows.repartition("conv").withColumn(
        "fault",
        F.when(shown == "", BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), IS_TRUNCATED)
        .otherwise(SOUND),
    )


EDITS = "edit_no long, edit string, turn long, role string, text string"
REPORT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)


def repair(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    conversations: DataFrame | None = None,
    edits: bool = True,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """The cheapest edits that repair each conversation, or a report on each.

    With ``edits`` one row per edit: ``edit_no`` from 0, ``edit`` (K kept, R given another
    role, D deleted, I inserted), ``turn`` (null if inserted), ``role`` and ``text`` as
    they are afterwards; the rows other than D are the repaired conversation. Without, one
    row per conversation: ``gaps`` in the turn numbers, rows by first fault (``blank``,
    ``duplicate``, ``truncated``), ``illegal`` neighbours, ``cost``, the edits' letters as
    ``audit`` and the SHA-256 of the repaired ``role:text`` lines. Of equally cheap edits
    the letters that come first in ASCII are taken.

    Rows are taken in the order of turn (null first), role and text, so ties have one
    order and equal rows are repeats of the first. A null role or text counts as one
    space; a null conversation is one of its own. A role is known by its first character;
    a row whose role is empty cannot be kept as it is. ``conversations`` names, in the
    column ``conversation``, those that are reported even if they have no row left: zeros,
    no letters and the SHA-256 of nothing. An empty table gives no rows. Other columns are
    not read.

    A conversation streams through one task, however long, as its edits depend on each
    other; the task holds one Arrow batch, the choices of two blocks and the letters.
    """
    if conversation.lower() in {c.split()[0] for c in f"{EDITS}, {REPORT}".split(", ")}:
        raise ValueError(f"the conversation column is named like a result: {conversation}")
    conv = F.col(f"`{conversation}`")
    turns = rows.select(
        conv.alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    judged = turns_with_faults(turns)
    conv_type = turns.schema["conv"].dataType.simpleString()

    # Of equal rows the one that is no repeat comes first.
    order, repeated = ("turn", "role", "text"), F.col("fault") == DUPLICATE
    spill = f"conv {conv_type}, turn long, role string, text string, number long, choices binary"
    blocks = written(
        judged.sortWithinPartitions(
            "conv", *(F.desc_nulls_last(c) for c in order), repeated.desc()
        ).mapInArrow(_choices(_arrow(spill), block_turns), spill),
        "repair-choices",
    )
    nothing = {"number": F.lit(None).cast("long"), "choices": F.lit(None).cast("binary")}
    marks = (rows if conversations is None else conversations).select(conv.alias("conv")).distinct()
    stream = (
        judged.withColumns({**nothing, "kind": F.lit(_ROW)})
        .unionByName(blocks.withColumns({"fault": F.lit(SOUND), "kind": F.lit(_CHOICES)}))
        .unionByName(marks.withColumn("kind", F.lit(_MARK)), allowMissingColumns=True)
        .repartition("conv")
        .sortWithinPartitions(
            "conv", *(F.asc_nulls_first(c) for c in order), "kind", F.desc("number"), repeated
        )
    )
    out = f"`{conversation}` {conv_type}, {EDITS if edits else REPORT}"
    return stream.mapInArrow(_follow(_arrow(out), edits), out)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))
