"""Repair of conversation structure by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn inside each partition; one pass of
``mapInPandas`` then carries a small dynamic program from row to row and from batch to
batch. Its states are the places in the pattern ``(s?(ua)+)?``: nothing yet, after the
system row, after a user row, after an assistant row. Only the differences between the
states' costs and the order of their edit strings matter for what follows, so the states
of all conversations are a few dozen distinct vectors whose steps are worked out once.

A row leaves two bytes behind, the number of its step. Whenever a block of rows is full,
each state still alive turns its steps into the edits of the block, one letter a row,
brings its running hash up to date, and the rows are forgotten. The edits of full blocks
go to a file of the task's own beyond ``SPOOL_BYTES``; it vanishes with the task, like
Spark's own spill. Memory is a block plus the audit of one conversation, however long.

Defined results: missing roles and texts, and missing parts of the key of the damage, read
as one space. Rows of equal turn go by role, then text. Repeated rows are rows of their own
and therefore duplicates. Missing conversation ids are one conversation. A conversation
without rows after damage has zeros, an empty audit and the hash of an empty string; an
empty table has no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3
BLOCK_ROWS = 4096
BLOCK_CHARS = 1_000_000
SPOOL_BYTES = 1 << 20
# A state dearer than the best by more than this never wins: any future of a state is open to
# another for at most one insert and one delete more.
HOPELESS = INSERT + DELETE

START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
# The one role that can be written after each state, and where it leads.
WRITES = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)

Vector = tuple[tuple[int, int, int], ...]  # (state, cost above the best, place in the order of the edit strings)


@dataclass(frozen=True)
class Step:
    """What a row does to a vector of states."""

    cost: int
    after: Vector
    back: dict[int, tuple[int, str]]  # state after the row: state before it, edits in between


def inserted(state: int, times: int) -> int:
    for _ in range(times):
        state = WRITES[state][1]
    return state


@lru_cache(maxsize=4096)
def step(before: Vector, initial: str, fault: int) -> Step:
    """The cheapest ways, ties to the smaller edit string, into every state after a row.

    Edit strings of different states before a row end in a row's letter, so none begins
    with another: their order decides a comparison whatever follows.
    """
    extra = TRUNCATED if fault == CUT_OFF else 0
    best: dict[int, tuple[int, int, str, int]] = {}
    for state, cost, place in before:
        for times in range(3):
            at, paid, edits = inserted(state, times), cost + INSERT * times, "I" * times
            ways = [(at, paid + DELETE, edits + "D")]
            if fault not in (BLANK, DUPLICATE):
                ways.append((WRITES[at][1], paid + REROLE + extra, edits + "R"))
                if (at, initial) in KEEPS:
                    ways.append((KEEPS[at, initial], paid + extra, edits + "K"))
            for into, total, letters in ways:
                best[into] = min(best.get(into, (1 << 30, 0, "", 0)), (total, place, letters, state))
    cheapest = min(total for total, *_ in best.values())
    alive = {s: way for s, way in best.items() if way[0] - cheapest <= HOPELESS}
    order = sorted(alive, key=lambda s: alive[s][1:3])
    after = tuple((s, alive[s][0] - cheapest, order.index(s)) for s in sorted(alive))
    return Step(cheapest, after, {s: (way[3], way[2]) for s, way in alive.items()})


def finish(vector: Vector) -> tuple[int, int, int]:
    """State to end in, the inserts it still needs, what they cost above the best."""
    ways = []
    for state, cost, place in vector:
        needed = next(n for n in range(3) if inserted(state, n) in ACCEPTING)
        ways.append((cost + INSERT * needed, place, state, needed))
    cost, _, state, needed = min(ways)
    return state, needed, cost


@dataclass
class Repair:
    """The stream of one conversation."""

    vector: Vector = ((START, 0, 0),)
    cost: int = 0
    steps: array = field(default_factory=lambda: array("H"))
    rows: list[tuple[str, str]] = field(default_factory=list)
    chars: int = 0
    hashes: dict = field(default_factory=lambda: {START: (hashlib.sha256(), True)})
    blocks: list[dict[int, tuple[int, int, int]]] = field(default_factory=list)
    spool: tempfile.SpooledTemporaryFile | None = None
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    initial: str | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: int, numbers: dict, known: list[Step]) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.faults[fault] += 1
        key = (self.vector, initial if initial in ("s", "u", "a") else "", fault)
        number = numbers.get(key)
        if number is None:
            number = numbers[key] = len(known)
            known.append(step(*key))
        done = known[number]
        self.steps.append(number)
        self.cost += done.cost
        self.vector = done.after
        self.rows.append((role, text))
        self.chars += len(text)
        if len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS:
            self._settle([s for s, *_ in self.vector], known)

    def _settle(self, ends: list[int], known: list[Step]) -> None:
        """Turn the block's steps into edits and hashes of the states it can end in."""
        if self.spool is None:
            self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        index, hashes = {}, {}
        for end in ends:
            state, parts = end, []
            for number in reversed(self.steps):
                state, letters = known[number].back[state]
                parts.append(letters)
            parts.reverse()
            hashes[end] = self._hashed(state, parts)
            edits = "".join(parts).encode()
            index[end] = (state, self.spool.seek(0, 2), len(edits))
            self.spool.write(edits)
        self.blocks.append(index)
        self.hashes = hashes
        self.steps, self.rows, self.chars = array("H"), [], 0

    def _hashed(self, state: int, parts: list[str]) -> tuple:
        """The hash of ``state`` before the block, carried over the edits of the block."""
        running, empty = self.hashes[state]
        running = running.copy()
        lines: list[str] = []
        for letters, (role, text) in zip(parts, self.rows):
            for letter in letters:
                if letter == "D":
                    continue
                written, into = WRITES[state]
                if letter == "K":
                    lines.append(f"{role}:{text}")
                    state = KEEPS[state, role[:1]]
                else:
                    lines.append(f"{ROLES[written]}:{text if letter == 'R' else ''}")
                    state = into
        if lines:
            running.update((("" if empty else "\n") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
        return running, empty and not lines

    def result(self, known: list[Step]) -> tuple:
        end, needed, cost = finish(self.vector)
        self._settle([end], known)
        running, empty = self.hashes[end]
        parts, state = ["I" * needed], end
        for index in reversed(self.blocks):
            state, start, size = index[state]
            self.spool.seek(start)
            parts.append(self.spool.read(size).decode())
        self.spool.close()
        tail = [f"{ROLES[WRITES[inserted(end, n)][0]]}:" for n in range(needed)]
        if tail:
            running.update((("" if empty else "\n") + "\n".join(tail)).encode())
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return (gaps, *self.faults[1:], self.illegal, self.cost + cost, "".join(reversed(parts)), running.hexdigest())


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One result a conversation from rows sorted by conversation and turn."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    numbers: dict = {}
    known: list[Step] = []
    current, repair = None, None
    out: list[tuple] = []

    def frame() -> pd.DataFrame:
        table = pd.DataFrame(out, columns=names)
        table["conv_id"] = pd.array([row[0] for row in out], dtype="Int64")
        out.clear()
        return table

    for batch in batches:
        columns = (batch[c].tolist() for c in ("conv", "lost", "turn", "no_turn", "gone", "role", "text", "fault"))
        for conv, lost, turn, no_turn, gone, role, text, fault in zip(*columns):
            if repair is None or (conv, lost) != current:
                if repair is not None:
                    out.append((None if current[1] else current[0], *repair.result(known)))
                current, repair = (conv, lost), Repair()
            if not gone:
                repair.add(None if no_turn else turn, role, text, fault, numbers, known)
        if out:
            yield frame()
    if repair is not None:
        out.append((None if current[1] else current[0], *repair.result(known)))
        yield frame()


_NOT_BLANK = r"[^\x20\x09-\x0D]"


def repair(rows: DataFrame) -> DataFrame:
    """Faults and the cheapest repair of every conversation.

    ``rows``: ``conv_id long, turn long, role string, text string, gone boolean, copy int``.
    Rows marked gone do not count, but their conversation appears.
    """
    last = F.regexp_extract("text", rf"({_NOT_BLANK})[\x20\x09-\x0D]*\z", 1)
    # The window's keys include the conversation, so it works on the partitions made here.
    dealt = rows.repartition("conv_id")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn"), "copy")
    fault = (
        F.when(~F.col("text").rlike(_NOT_BLANK), BLANK)
        .when(F.row_number().over(seen) > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), CUT_OFF)
        .otherwise(SOUND)
    )
    told = dealt.withColumn("fault", fault).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "copy")
    # Missing numbers travel as flags: pandas would turn the column into doubles.
    return told.select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
        F.col("conv_id").isNull().alias("lost"),
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
        F.col("turn").isNull().alias("no_turn"),
        "gone",
        "role",
        "text",
        "fault",
    ).mapInPandas(_stream, RESULT)


def _spaced(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as :func:`repair` takes them, damaged by the checksum of conversation and turn.

    Of its remainder by 20, 0 drops a row, 1 empties its text, 2 removes its sentence
    ends, 3 repeats it, 4 makes its role ``user``.
    """
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (
        conversations.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), kind.alias("kind"))
        .withColumn("text", text)
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone"), "copy")
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Faults and repairs of all conversations after :func:`damage`."""
    return repair(damage(conversations))
