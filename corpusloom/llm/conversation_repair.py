"""Repair of conversations whose turns don't alternate, by the cheapest edits.

A conversation in good order is empty or ``s?(ua)+`` in its roles' initials: an optional system turn, then user and assistant in turns.  Each turn is
kept, given another role or deleted, and turns may be inserted; a depth-first branch and bound finds the cheapest such edits, and of equally
cheap ones those whose initials come first (see ``cheapest``).

A conversation is one value of the result, so its turns meet in one task; but they pass it as two sorted streams.  The first
carries a turn's role and faults only, the second its text and what to do with it, so no text is held, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.frames import once
from corpusloom.llm.rows import column, in_arrow, materialize

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3  # a turn's fault; 0 is none
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 1, 2, 5, 5  # costs
ORDERLY = ("su", "ua", "au")  # neighbours' initials
# What was emitted last: nothing, the system turn, a user's, an assistant's; and what may follow it.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
COMPLETE = (START, ASSISTANT)
_SPACE = " \t\n\x0b\x0c\r"


def suffix_bounds(turns: list[tuple[str, int]]) -> list[list[float]]:
    """For each place among ``turns`` (initial, fault) and each state no more than what the rest costs.

    Deleting is open to every turn; what else a turn costs depends on its initial and its fault; behind each turn as many turns as needed are inserted.
    """

    def with_inserts(costs: list[float]) -> list[float]:
        for _ in range(3):  # no state is more than three inserted turns away from another
            costs = [min([costs[s], *(INSERT + costs[AFTER[s][r]] for r in "ua" if r in AFTER[s])]) for s in range(4)]
        return costs

    bounds = [with_inserts([0 if s in COMPLETE else float("inf") for s in range(4)])]
    for initial, fault in reversed(turns):
        after = bounds[-1]
        costs = [DELETE + c for c in after]
        if fault not in (BLANK, DUPLICATE):
            extra = LEFT_TRUNCATED if fault == TRUNCATED else 0
            for s in range(4):
                for role, state in AFTER[s].items():
                    if role == initial:
                        costs[s] = min(costs[s], extra + after[state])
                    if role != "s":
                        costs[s] = min(costs[s], REROLE + extra + after[state])
        bounds.append(with_inserts(costs))
    return bounds[::-1]


def cheapest(turns: list[tuple[str, int]], bounds: list[list[float]] | None = None) -> tuple[int, str]:
    """(cost, audit) of the best edits: the initials of Delete, Insert, Keep and Rerole in order.

    Depth first with an explicit stack.  A node is a place among the turns and a state; its branches are followed in the
    order of their initials.  So a node is always reached by ascending audits: a prefix that comes later is worse unless it costs less than the one in the node's
    dominance table, and a complete solution is better than the incumbent only if it costs less.  A prefix whose cost and suffix bound reach the
    incumbent's cost is cut off as well.  Until there is an incumbent, a ceiling takes its place: one more than the bound of the whole, and
    one more again if the stack runs empty below it.  An empty stack with an incumbent proves that it is the best.
    ``suffix_bounds`` counts everything that a cost depends on, so with it no branch is taken in vain and the work grows with the number of turns; any lower
    bounds give the same result.
    """
    bounds = bounds or suffix_bounds(turns)
    ceiling = bounds[0][START] + 1
    while (found := _below(turns, bounds, ceiling)) is None:
        ceiling += 1
    return found


def _below(turns: list[tuple[str, int]], bounds: list[list[float]], ceiling: float) -> tuple[int, str] | None:
    """The best edits that cost less than the ceiling."""
    n = len(turns)
    table: list[list[float]] = [[float("inf")] * 4 for _ in range(n + 1)]  # least cost that a node was reached at
    incumbent: tuple[float, str | None] = (ceiling, None)
    path: list[str] = []
    stack = [(0, START, 0, 0, "")]  # place, state, cost, length of the audit before the last edit, last edit
    while stack:
        place, state, cost, depth, edit = stack.pop()
        if cost >= table[place][state] or cost + bounds[place][state] >= incumbent[0]:
            continue
        table[place][state] = cost
        del path[depth:]
        path.append(edit)
        if place == n and state in COMPLETE:
            incumbent = cost, "".join(path)
            continue
        follow = AFTER[state]
        inserted = [(place, follow[r], cost + INSERT, "I") for r in "ua" if r in follow]
        branches = inserted
        if place < n:
            initial, fault = turns[place]
            branches = [(place + 1, state, cost + DELETE, "D"), *inserted]
            if fault not in (BLANK, DUPLICATE):
                stays = cost + (LEFT_TRUNCATED if fault == TRUNCATED else 0)
                if initial in follow:
                    branches.append((place + 1, follow[initial], stays, "K"))
                branches += [(place + 1, follow[r], stays + REROLE, "R") for r in "ua" if r in follow]
        stack += [(*branch[:3], len(path), branch[3]) for branch in reversed(branches)]
    return None if incumbent[1] is None else (int(incumbent[0]), incumbent[1])


@dataclass
class _Turns:
    """One conversation's turns without their texts, as they come."""

    turns: list[tuple[str, int]] = field(default_factory=list)
    first: int | None = None
    last: int | None = None
    distinct: int = 0
    illegal: int = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if self.turns and self.turns[-1][0] + initial not in ORDERLY:
            self.illegal += 1
        self.turns.append((initial, fault))

    def row(self) -> tuple:
        faults = [sum(f == which for _, f in self.turns) for which in (BLANK, DUPLICATE, TRUNCATED)]
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.distinct, (1 << 63) - 1)
        return (gaps, *faults, self.illegal, *cheapest(self.turns))


_ORDER = ("conv_id", "turn", "role", "digest")


def _solved(narrow: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost and audit.  ``narrow`` has each partition's turns in order; lost turns have no role."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

        def rows_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, columns, strict=True)], names=names)

        current, own, done = None, None, []
        for batch in batches:
            for conv_id, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")), strict=True):
                if own is None or conv_id != current:
                    if own is not None:
                        done.append((current, *own.row()))
                    current, own = conv_id, _Turns()
                if initial is not None:
                    own.add(turn, initial, fault)
            if done:
                yield rows_of(done)
                done = []
        if own is not None:
            yield rows_of([(current, *own.row())])

    return in_arrow(narrow, step, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Repaired:
    """The hash of a repaired conversation, whose turns come one by one after its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.hash, self.empty = audit, 0, START, hashlib.sha256(), True

    def _emit(self, role: str, text: str, initial: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "replace"))
        self.empty, self.state = False, AFTER[self.state][initial]

    def _next(self) -> tuple[str, str]:
        """Role and initial of a turn that is inserted or given another role: the only one that may follow."""
        return ("assistant", "a") if self.state == USER else ("user", "u")

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            role, initial = self._next()
            self._emit(role, "", initial)
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._emit(role, text, role[0])
        elif edit == "R":
            new, initial = self._next()
            self._emit(new, text, initial)

    def digest(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def _hashed(stream: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) from each conversation's audit, which comes first, and its turns in order."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own, done = None, None, []
        for batch in batches:
            for conv_id, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True):
                if audit is not None:
                    if own is not None:
                        done.append((current, own.digest()))
                    current, own = conv_id, _Repaired(audit)
                else:
                    own.add(role, text)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["conv_id", "repaired_sha256"])
            done = []
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([own.digest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return in_arrow(stream, step, "conv_id long, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``turns`` has conv_id, turn, role and text; a row with a null role counts for its conversation's presence only (a lost turn).
    Turns are taken by ``turn`` (null first), equal ones by role and the text's MD5; a null text is empty, and a null conv_id
    is a conversation of its own.  A turn is *blank* without a character other than ASCII white space, else a *duplicate* if its role and text stand earlier in the conversation, else
    *truncated* if its last such character is none of ``.!?``; ``illegal`` counts neighbours whose roles' initials aren't su, ua or au.
    gaps counts the numbers that are missing between the smallest and the largest turn.

    A turn is kept (if its role's initial fits) for nothing, given the role user or assistant for 1, or deleted for 2; blank and duplicate turns have to be deleted; a truncated turn
    that stays costs 5 more.  A user's or assistant's turn with an empty text is inserted for 5.  What results reads ``(s?(ua)+)?`` in initials; repaired_sha256 is over its
    lines ``role:text``.  An empty table gives an empty result; other columns are ignored.
    """
    rows = turns.select(
        column("conv_id").cast("long").alias("conv_id"), column("turn").cast("long").alias("turn"), column("role").alias("role"),
        F.when(column("role").isNotNull(), F.coalesce(column("text"), F.lit(""))).alias("text"),
    )
    visible = F.rtrim(F.col("text"), F.lit(_SPACE))
    rows = once(rows, digest=F.md5("text"), ending=F.right(visible, F.lit(1)))
    # One exchange by conversation serves the numbering and the stream; neither holds texts.
    narrow = rows.select("conv_id", "turn", "role", "digest", "ending").repartition("conv_id")
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("ending") == "", BLANK).when(again, DUPLICATE).when(~F.col("ending").isin(*".!?"), TRUNCATED).otherwise(0)
    classed = narrow.withColumns({"fault": fault, "initial": F.substring("role", 1, 1)}).sortWithinPartitions(*_ORDER)
    solved = materialize(_solved(classed.select("conv_id", "turn", "initial", "fault")), "audits")

    audits = solved.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))])
    texts = rows.filter("role IS NOT NULL").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "digest", "text")
    stream = audits.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER[1:])
    hashes = _hashed(stream.select("conv_id", "audit", "role", "text")).withColumnRenamed("conv_id", "its_id")
    return solved.join(hashes, F.col("conv_id").eqNullSafe(F.col("its_id"))).drop("its_id")


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with faults that follow from CRC-32 of ``conv_id:turn`` modulo 20.

    0 loses the turn (its role and text become null), 1 empties its text, 2 takes the marks ``.!?`` out of it, 3 repeats it, 4 makes it
    the user's.  Nulls in role and text, and in conv_id and turn for the checksum, count as one space.
    """
    spaced = [F.coalesce(column(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    code = F.crc32(F.concat_ws(":", *spaced[:2]).cast("binary")) % 20
    rows = conversations.select(column("conv_id").alias("conv_id"), column("turn").alias("turn"), code.alias("code"), spaced[2].alias("role"), spaced[3].alias("text"))
    lost, emptied, unmarked, repeated, turned = (F.col("code") == c for c in range(5))
    role = F.when(~lost, F.when(turned, "user").otherwise(F.col("role")))
    text = F.when(~lost, F.when(emptied, "").when(unmarked, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(repeated, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")
