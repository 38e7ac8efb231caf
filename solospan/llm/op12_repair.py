"""Conversation structure repair by a dynamic program with square-root checkpoints.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Rows are kept,
given another role, deleted (blank and duplicate rows must be) or put in, each
at a cost; the cheapest edits are wanted, and of those the ones whose initials
are least in ASCII order.

The program has four states (nothing yet, after ``s``, ``u`` or ``a``).  The
costs to the end from the four states form a vector; walking backward over the
rows gives it, less its minimum, before every row.  Only every ``sqrt(n)``-th
vector is stored.  Walking forward, a block's vectors are computed again from
the checkpoint behind it, and at each place the least tight edit (deletion,
insertion, keeping, another role) is taken.  There are few different vectors,
so both steps are looked up once met.

In Spark, each row is sent to its conversation's task twice: first without its
text as one byte of what the program needs to know, then with it.  Both times in the order of the conversation, so a task
streams through: it holds the bytes of one conversation (as many as its audit
has letters), the checkpoints and one block, never the texts.  Repeats are
marked before by a window over digests of role and text.  The texts are shuffled
once.  One conversation is one stream, whatever its size: a digest of
its repaired text needs the rows one after the other.

Defined results: conversations are told apart by their id, null is an id too;
a null role or text counts as one space; rows go by turn, nulls first, equal turns by role,
first 64 characters and digest of the text; repeated rows are duplicates; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 10**6
OTHER, BLANK, REPEAT = 3, 64, 128  # a row's code: initial (0 s, 1 u, 2 a, 3 other), plus 4 if truncated; blank; repeat

Costs = tuple[int, int, int, int]


def following(state: int) -> int:
    """The state after the role that must come next."""
    return ASSISTANT if state == USER else USER


def kept_state(state: int, initial: int) -> int | None:
    """The state after a kept row, if its initial may stand here."""
    if initial == 0:
        return SYSTEM if state == START else None
    return following(state) if initial < OTHER and initial == following(state) - 1 else None


def with_insertions(costs: list[int]) -> Costs:
    u = min(costs[USER], INSERT + costs[ASSISTANT])
    a = min(costs[ASSISTANT], INSERT + u)
    u = min(u, INSERT + a)
    return min(costs[START], INSERT + u), min(costs[SYSTEM], INSERT + u), u, a


END: Costs = with_insertions([0, NEVER, NEVER, 0])


class Program:
    """The two steps of the dynamic program, remembered."""

    def __init__(self) -> None:
        self.backward: dict[tuple[int, Costs], Costs] = {}
        self.forward: dict[tuple[int, Costs, int], tuple[str, int]] = {}

    @staticmethod
    def edits(code: int, state: int) -> Iterator[tuple[str, int, int]]:
        """What may be done with a row: letter, cost, next state."""
        yield "D", DELETE, state
        if code < BLANK:
            late = TRUNCATED if code & 4 else 0
            if (kept := kept_state(state, code & 3)) is not None:
                yield "K", late, kept
            yield "R", REROLE + late, following(state)

    def row(self, code: int, after: Costs) -> list[int]:
        """Costs from each state if the row is dealt with next."""
        return [min(cost + after[state] for _, cost, state in self.edits(code, s)) for s in range(4)]

    def before(self, code: int, after: Costs) -> Costs:
        """The vector before a row from that behind it."""
        if (code, after) not in self.backward:
            costs = with_insertions(self.row(code, after))
            least = min(costs)
            self.backward[code, after] = tuple(c - least for c in costs)  # type: ignore[assignment]
        return self.backward[code, after]

    def walk(self, code: int, after: Costs, state: int) -> tuple[str, int]:
        """The letters at a row (insertions, then what is done with it) and the state behind it."""
        if (code, after, state) not in self.forward:
            costs, letters, s = with_insertions(self.row(code, after)), "", state
            while True:
                tight = [(x, to) for x, cost, to in self.edits(code, s) if cost + after[to] == costs[s]]
                tight += [("I", following(s))] if INSERT + costs[following(s)] == costs[s] else []
                letter, s = min(tight)
                letters += letter
                if letter != "I":
                    break
            self.forward[code, after, state] = letters, s
        return self.forward[code, after, state]


class Repair:
    """The edits of one conversation: all its codes first, then its rows one by one."""

    def __init__(self, program: Program):
        self.program = program
        self.codes = bytearray()
        self.at, self.state = 0, START
        self.block: list[Costs] = []

    def checkpoints(self) -> None:
        """Walk backward once; keep a vector at the end of every block."""
        self.size = isqrt(len(self.codes)) + 1
        costs, self.stored = END, {}
        for i in range(len(self.codes) - 1, -1, -1):
            if (i + 1) % self.size == 0 or i + 1 == len(self.codes):
                self.stored[i // self.size] = costs
            costs = self.program.before(self.codes[i], costs)

    def next(self) -> str:
        """The letters at the next row."""
        if self.at == 0:
            self.checkpoints()
        if self.at % self.size == 0:
            costs = self.stored[self.at // self.size]
            self.block = []
            for code in reversed(self.codes[self.at : self.at + self.size]):
                self.block.append(costs)  # the vector behind the row
                costs = self.program.before(code, costs)
        letters, self.state = self.program.walk(self.codes[self.at], self.block.pop(), self.state)
        self.at += 1
        return letters

    def last(self) -> str:
        """The insertions behind the last row."""
        letters = ""
        while END[self.state]:
            letters, self.state = letters + "I", following(self.state)
        return letters


class Edit(NamedTuple):
    """One edit: ``was`` is the row's role before, ``role`` and ``text`` what stands afterwards (null: deleted)."""

    conv_id: int | None
    place: int | None
    edit: str | None
    turn: int | None
    was: str | None
    fault: str | None
    role: str | None
    text: str | None


EDITS = "conv_id long, place long, edit string, turn long, was string, fault string, role string, text string"


def conversation_edits(rows: Iterable[tuple]) -> Iterator[Edit]:
    """Edits of all conversations, each one's in order.

    ``rows`` are (conv_id, phase, turn, role, copies, code, text), by
    conversation and phase.  A conversation without a row gives one edit of
    nulls.
    """
    program, repair, place = Program(), None, 0
    conv: object = repair

    def put(letters: str, row: tuple | None, state: int) -> Iterator[Edit]:
        nonlocal place
        for letter in letters:
            if letter == "I":
                state = following(state)
                yield Edit(conv, place, "I", None, None, None, NAMES[state], "")  # type: ignore[arg-type]
            else:
                _, _, turn, role, _, code, text = row  # type: ignore[misc]
                fault = "blank" if code & BLANK else "duplicate" if code & REPEAT else "truncated" if code & 4 else None
                after = None if letter == "D" else role if letter == "K" else NAMES[following(state)]
                yield Edit(conv, place, letter, turn, role, fault, after, None if letter == "D" else text)  # type: ignore[arg-type]
            place += 1

    def finish() -> Iterator[Edit]:
        if repair is not None:
            state = repair.state
            yield from put(repair.last(), None, state)
            if not repair.codes:
                yield Edit(conv, *[None] * 7)  # type: ignore[arg-type]

    for row in rows:
        conv_id, phase, _, _, copies, code, _ = row
        if repair is None or conv_id != conv:
            yield from finish()
            repair, conv, place = Repair(program), conv_id, 0
        if phase == 0:
            first = bytes([code])
            again = bytes([code if code & BLANK else code & ~BLANK | REPEAT])
            repair.codes += (first + again * (copies - 1)) if copies else b""
            continue
        for _ in range(copies):
            state = repair.state
            here = (*row[:5], repair.codes[repair.at], row[6])
            yield from put(repair.next(), here, state)
    yield from finish()


def fault_rows(rows: DataFrame) -> DataFrame:
    """The rows as :func:`conversation_edits` takes them, each conversation in one partition.

    ``rows`` has conv_id, turn, role, text and copies (how often the row stands
    here; 0: only its conversation is known).
    """
    last = F.expr(r"right(rtrim(' \t\n\u000B\f\r', text), 1)")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    code = F.when(last == "", F.lit(BLANK)).otherwise(code + F.when(last.isin(".", "!", "?"), 0).otherwise(4))
    order = ["turn", "role", "_head", "_d1", "_d2"]
    base = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.col("copies").cast("int").alias("copies"),
    ).select(
        "*",
        code.cast("int").alias("code"),
        F.left("text", F.lit(64)).alias("_head"),
        F.xxhash64("role", "text").alias("_d1"),
        F.xxhash64("text", "role", F.lit(1)).alias("_d2"),
    )
    number = F.row_number().over(Window.partitionBy("conv_id", "_d1", "_d2").orderBy(F.col("copies") == 0, "turn", "role", "_head"))
    codes = base.drop("text").withColumn("_n", number)
    codes = codes.withColumn("code", F.when((F.col("_n") > 1) & (F.col("code") < BLANK), F.col("code") + REPEAT).otherwise(F.col("code")))
    first = codes.select("conv_id", F.lit(0).alias("phase"), *order, "copies", "code", "_n", F.lit(None).cast("string").alias("text"))
    second = base.where("copies > 0").select("conv_id", F.lit(1).alias("phase"), *order, "copies", "code", F.lit(0).alias("_n"), "text")
    both = first.unionByName(second).repartition("conv_id").sortWithinPartitions("conv_id", "phase", *order, "_n")
    return both.select("conv_id", "phase", "turn", "role", "copies", "code", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()


def repaired_rows(rows: DataFrame) -> DataFrame:
    """Every edit of every conversation: conv_id, place (from 0), edit (D, I, K or R), turn, was, fault, role, text.

    ``rows`` as for :func:`fault_rows`.
    """
    text, long = pa.string(), pa.int64()
    schema = pa.schema(list(zip(Edit._fields, [long, long, text, long, text, text, text, text], strict=True)))
    return fault_rows(rows).mapInArrow(lambda batches: _batches(conversation_edits(_streamed(batches)), schema), EDITS)


class Digest:
    """Figures of one conversation, gathered from its edits in order."""

    COLUMNS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    ALLOWED = frozenset(["su", "ua", "au"])

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.first = self.last = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit: list[str] = []
        self.sha, self.stands = hashlib.sha256(), False

    def add(self, e: Edit) -> None:
        if e.edit is None:
            return
        self.audit.append(e.edit)
        if e.edit != "I":
            if e.turn is not None and e.turn != self.last:  # turns come in order
                self.first = e.turn if self.first is None else self.first
                self.last, self.turns = e.turn, self.turns + 1
            initial = e.was[:1]  # type: ignore[index]
            self.illegal += self.before is not None and self.before + initial not in self.ALLOWED
            self.before = initial
            if e.fault:
                self.faults[e.fault] += 1
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e.edit] + (TRUNCATED if e.fault == "truncated" and e.edit != "D" else 0)
        if e.edit != "D":
            self.sha.update(f"{'\n' if self.stands else ''}{e.role}:{e.text}".encode())
            self.stands = True

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0  # type: ignore[operator]
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, faults, illegal neighbours, cost, the edits' initials and a digest of the repaired text."""
    text, long = pa.string(), pa.int64()
    schema = pa.schema([(c.split()[0], text if c.endswith("string") else long) for c in Digest.COLUMNS.split(", ")])

    def digests(edits: Iterable[Edit]) -> Iterator[tuple]:
        digest = None
        for e in edits:
            if digest is None or e.place is None or e.place == 0:
                if digest is not None:
                    yield digest.row()
                digest = Digest(e.conv_id)
            digest.add(e)
        if digest is not None:
            yield digest.row()

    return fault_rows(rows).mapInArrow(lambda batches: _batches(digests(conversation_edits(_streamed(batches))), schema), Digest.COLUMNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults put in by crc32 of ``conv_id:turn`` modulo 20 (a null is one space).

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats
    the row, 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind: Column = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
