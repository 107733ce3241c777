"""Repairs the turn structure of conversations by the cheapest edits, with an audit of what was done.

The roles of a repaired conversation begin with an optional system turn, then user and assistant alternate and the
assistant comes last; an empty conversation is fine. ``K`` keeps a row, ``R`` makes it a user or assistant row, ``D`` deletes
it, ``I`` inserts an empty user or assistant row. What stands so far decides which role ``R`` and ``I`` give, so the audit
string says everything; of equally cheap ones the ASCII-least is taken.

A row is a symbol: the first letter of its role and its fault. Runs of equal symbols are kept as lengths. Over four states
(nothing, system, user, assistant stands last) a symbol is a 4 x 4 matrix of costs in min-plus algebra, and a run is passed by
the binary powers of its matrix, which are cached. The choices are then unrolled from the front, a run by halves.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.session import staged

Vector = tuple[int, int, int, int]
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
FAR = 1 << 50
ROLES = "sua"  # a symbol is the place of the role's first letter here (3: another) + 4 x fault
FINE, CUT, TWICE, BLANK = 0, 4, 8, 12  # faults; rows of the last two must go
FORCED = (2, 2, 3, 2)  # the state after the role that may come next: user, user, assistant, user
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role letter: where a row may stay, and the state after it
LAST = (0, 2 * INSERT, INSERT, 0)  # cost of ending in each state
LEGAL = {(0, 1), (1, 2), (2, 1)}
BLANKS = " \t\n\x0b\f\r"
UNROLLED = 1024  # longest stretch of a run whose choices are cached


def _times(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


@cache
def power(symbol: int, k: int) -> tuple[Vector, ...]:
    """The matrix of 2^k rows of a symbol: least cost from the state before them to the state after."""
    if k:
        half = power(symbol, k - 1)
        return _times(half, half)
    insert = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        insert[state][state], at, cost = 0, FORCED[state], INSERT
        while insert[state][at] > cost:
            insert[state][at], at, cost = cost, FORCED[at], cost + INSERT
    row = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        row[state][state] = DELETE
        if symbol < TWICE:
            more = TRUNCATED if symbol >= CUT else 0
            row[state][FORCED[state]] = min(row[state][FORCED[state]], REROLE + more)
            if state in KEPT[symbol & 3]:
                row[state][KEPT[symbol & 3][state]] = KEEP + more
    return _times(tuple(map(tuple, insert)), tuple(map(tuple, row)))


def before(symbol: int, n: int, after: Vector) -> Vector:
    """Costs to go before a run of ``n`` rows, from those after it."""
    k = 0
    while n:
        if n & 1:
            after = tuple(min(m[j] + after[j] for j in range(4)) for m in power(symbol, k))
        n, k = n >> 1, k + 1
    return after


def _unroll(symbol: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    """The least choices for ``n`` rows from ``state`` on, and the state after them."""
    if n > 1:
        half = 1 << ((n - 1).bit_length() - 1)
        middle = before(symbol, half, after)
        first, state = unroll(symbol, n - half, state, middle)
        rest, state = unroll(symbol, half, state, after)
        return first + rest, state
    here, out = before(symbol, 1, after), ""
    while True:
        more, stays = TRUNCATED if symbol >= CUT else 0, KEPT[symbol & 3].get(state)
        if here[state] == DELETE + after[state]:
            return out + "D", state
        if here[state] == INSERT + here[FORCED[state]]:
            out, state = out + "I", FORCED[state]
        elif stays is not None and here[state] == KEEP + more + after[stays]:
            return out + "K", stays
        else:
            return out + "R", FORCED[state]


_unroll_cached = lru_cache(1 << 14)(_unroll)


def unroll(symbol: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    if n > UNROLLED:
        return _unroll(symbol, n, state, after)
    least = min(after)  # only differences matter
    return _unroll_cached(min(symbol, TWICE), n, state, tuple(v - least for v in after))


def solve(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as runs (symbol, length)."""
    costs = [LAST]
    for symbol, n in reversed(runs):
        costs.append(before(min(symbol, TWICE), n, costs[-1]))
    total, state, audit = costs[-1][0], 0, []
    for symbol, n in runs:
        costs.pop()
        part, state = unroll(min(symbol, TWICE), n, state, costs[-1])
        audit.append(part)
    ends = 0
    while LAST[state]:
        state, ends = FORCED[state], ends + 1
    return total, "".join(audit) + "I" * ends


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    removes ``.!?`` from it, 3 repeats the row (``copies`` 2), 4 makes it a user's. Nulls count as one space."""
    def known(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    return turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), what.alias("what")).where("what <> 0").select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("what") == 3, 2).otherwise(1).cast("long").alias("copies"))


ORDER = ["conv", "has_turn", "turn", "role", "digest"]
RUNS = "array<struct<symbol:int,n:long>>"
PIECE = f"conv string, part int, first long, last long, turns long, runs {RUNS}"
HEAD = "audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted rows one row per conversation in this range: its runs, and first, last and number of turns."""
    part, conv, runs, turns = TaskContext.get().partitionId(), None, [], [None, None, 0]

    def add(symbol: int, n: int) -> None:
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += n
        else:
            runs.append([symbol, n])

    def out() -> pa.RecordBatch:
        made = {"symbol": [s for s, _ in runs], "n": [n for _, n in runs]}
        items = pa.StructArray.from_arrays([pa.array(made["symbol"], pa.int32()), pa.array(made["n"], pa.int64())], ["symbol", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([conv]), pa.array([part], pa.int32()), *[pa.array([t], pa.int64()) for t in turns],
             pa.ListArray.from_arrays(pa.array([0, len(runs)], pa.int32()), items)], ["conv", "part", "first", "last", "turns", "runs"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "has_turn", "turn", "role", "fault", "later", "n")]
        for own, has_turn, turn, role, fault, later, n in zip(*columns):
            if own != conv:
                if conv is not None:
                    yield out()
                conv, runs, turns = own, [], [None, None, 0]
            if has_turn and (turns[1] is None or turns[1] != turn):
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            letter = ROLES.find(role[:1]) if role else -1
            letter = 3 if letter < 0 else letter
            add(letter + (fault if fault == BLANK or not later else TWICE), 1)
            if n > 1:
                add(letter + (BLANK if fault == BLANK else TWICE), n - 1)
    if conv is not None:
        yield out()


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces."""
    for batch in batches:
        for row in batch.to_pylist():
            runs, first, last, turns = [], None, None, 0
            for piece in row["pieces"]:
                if piece["turns"]:
                    turns += piece["turns"] - (last == piece["first"])
                    first, last = piece["first"] if first is None else first, piece["last"]
                for run in piece["runs"]:
                    if runs and runs[-1][0] == run["symbol"]:
                        runs[-1] = (run["symbol"], runs[-1][1] + run["n"])
                    else:
                        runs.append((run["symbol"], run["n"]))
            cost, audit = solve(runs)
            faults, letters = Counter(), [s & 3 for s, _ in runs]
            for symbol, n in runs:
                faults[symbol & ~3] += n
            illegal = sum(n - 1 for _, n in runs) + sum(pair not in LEGAL for pair in zip(letters, letters[1:]))
            gaps = min(last - first + 1 - turns, 2**63 - 1) if turns else 0
            numbers = (gaps, faults[BLANK], faults[TWICE], faults[CUT], illegal, cost)
            yield pa.RecordBatch.from_arrays([pa.array([row["conv"]]), pa.array([audit]), *[pa.array([v], pa.int64()) for v in numbers]],
                                             ["conv", "audit", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"])


class _Repaired:
    """The digest of one repaired conversation, fed with its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.rows = audit, 0, 0, hashlib.sha256(), 0

    def _put(self, role: str, text: bytes) -> None:
        self.sha.update((b"\n" if self.rows else b"") + role.encode() + b":")
        self.sha.update(text)
        self.rows += 1

    def _forced(self) -> str:
        self.state = FORCED[self.state]
        return "user" if self.state == 2 else "assistant"

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._put(self._forced(), b"")
            self.at += 1

    def row(self, role: str, text: bytes) -> None:
        self.inserted()
        choice = self.audit[self.at]
        self.at += 1
        if choice == "K":
            self.state = KEPT[ROLES.find(role[0])][self.state]
            self._put(role, text)
        elif choice == "R":
            self._put(self._forced(), text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From every conversation's audit, followed by its rows in order, its digest. Holds one audit and a batch of rows."""
    conv, work = None, None

    def out() -> pa.RecordBatch:
        work.inserted()
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([work.sha.hexdigest()])], ["conv", "repaired_sha256"])

    for batch in batches:
        for own, audit, role, text, copies in zip(*[batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text", "copies")]):
            if audit is not None:
                if work:
                    yield out()
                conv, work = own, _Repaired(audit)
            else:
                for _ in range(copies):
                    work.row(role, text or b"")
    if work:
        yield out()


def repair(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` (conv_id, turn, role, text, copies) are the turns to repair; ``damaged`` makes them. They are taken by turn, null
    first; rows with one turn by role, then by the SHA-256 of role and text. A null conv_id is a conversation of its own; a
    conversation without rows has zeros, an empty audit and the digest of nothing. Null roles and texts count as one space, other
    columns are not read. A gap that does not fit a long is the largest long.

    Equal rows of a turn are counted before they move, earlier equal rows are found by an aggregate, rows are ordered in ranges
    that cut through conversations, and only runs leave a range. Runs and audit of one conversation are in one task, as the
    audit is one value; texts move once and stream through the digest of their conversation, which nothing can split.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    tail = F.rtrim(text, F.lit(BLANKS))
    fault = F.when(tail == "", BLANK).when(F.right(tail, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    keyed = rows.select(conv.alias("conv"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                        role.alias("role"), digest.alias("digest"), fault.alias("fault"), text.alias("text"), F.col("copies").cast("long").alias("copies"))
    narrow = staged(keyed.groupBy(*ORDER, "fault").agg(F.sum("copies").alias("n")), "rows")
    again = narrow.groupBy("conv", "role", "digest").agg(F.min(F.struct("has_turn", "turn")).alias("seen"), F.count("*").alias("c")).where("c > 1")
    marked = narrow.join(again.drop("c"), ["conv", "role", "digest"], "left").withColumn(
        "later", F.coalesce(F.col("seen") < F.struct("has_turn", "turn"), F.lit(False))).drop("seen")
    pieces = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(_pieces, PIECE)
    heads = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "first", "last", "turns", "runs"))).alias("pieces"))
    heads = heads.mapInArrow(_heads, f"conv string, {HEAD}")
    every = turns.groupBy(conv.alias("conv")).agg(F.first("conv_id").alias("conv_id")).join(heads, "conv", "left").select(
        "conv", "conv_id", F.coalesce("audit", F.lit("")).alias("audit"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
    every = staged(every, "heads")
    body = keyed.select("conv", F.lit(None).cast("string").alias("audit"), "has_turn", "turn", "role", "digest",
                        F.when(F.col("fault") != BLANK, F.col("text").cast("binary")).alias("text"), "copies")
    lead = every.select("conv", "audit", F.lit(None).cast("boolean").alias("has_turn"), *[
        F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "binary"), ("copies", "long"))])
    flow = lead.unionByName(body).repartition("conv").sortWithinPartitions(*ORDER)  # nulls first: the audit leads
    digests = flow.select("conv", "audit", "role", "text", "copies").mapInArrow(_digests, "conv string, repaired_sha256 string")
    return every.join(digests, "conv").drop("conv")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """``repair`` of conversations damaged by ``damaged``: one row per conv_id of ``turns``."""
    return repair(turns, damaged(turns))
