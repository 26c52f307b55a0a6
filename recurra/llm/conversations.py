"""Conversation structure repair by a lightest-derivation agenda (Knuth's generalisation of Dijkstra's algorithm).

A repair item (p, q) says that the first p rows of a conversation are repaired and that the roles so far bring the grammar
`(s?(ua)+)?` to state q. Its weight is (cost, audit), the audit being one letter an edit, and weights are compared in that order. Each
edit is a deduction from one item to the next: Keep, Rerole and Delete take a row, Insert takes none. All are superior functions: they add
to the cost or leave it and lengthen the audit, so a consequence is never lighter than its premise; and they are monotone: the cost of an
item's derivation follows from its audit, so of two of equal cost neither audit begins the other and the order of both survives what
is appended. So items leave the agenda in order of their weights, each with its lightest derivation, and the first goal item ends the search.

Spark places the rows of a conversation together and in order; a task reads them as a stream. A long conversation goes through
the agenda block by block: the items at a block's end, four at most, begin the next block, each with its hash of the repaired text so far, so
no conversation is held whole. (Its text has one hash, which has to be made in order; what is one conversation's is one task's work.)
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurra.llm.common import BLANKS

# Costs of the edits and of a truncated row that stays; ends of a finished text.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ENDS = ".!?"
# Rows that the agenda takes at once.
BLOCK = 256

# States of the grammar: nothing yet, after the system's turn, after a user's, after a whole pair.
_EMPTY, _SYSTEM, _USER, _PAIR = range(4)
_FINAL = (_EMPTY, _PAIR)
_MOVES = {(_EMPTY, "s"): _SYSTEM, (_EMPTY, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _PAIR, (_PAIR, "u"): _USER}
# The only role that may be made up in a state.
_NEXT = {_EMPTY: "user", _SYSTEM: "user", _USER: "assistant", _PAIR: "user"}
_LEGAL = ("su", "ua", "au")

# What is wrong with a row; a blank or repeated row must go.
FINE, BLANK, DUPLICATE, CUT = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `dropped`: rows as the contract damages them. Dropped rows stay, marked and without text, so that their
    conversations do."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    changed = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"), (kind == 0).alias("dropped"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return changed.select("conv_id", "turn", "role", "text", "dropped", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """`rows` with `fault`, the first that holds of blank, duplicate and cut off, in order of conversation and turn (none first)."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # Rows of one conversation are in one place already; its equal rows are found there without another move.
    placed = rows.repartition("conv_id").withColumn("_same", F.md5(F.col("text").cast("binary")))
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "_same", "dropped").orderBy(F.col("turn").asc_nulls_first()))
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", BLANK).when(F.col("_nth") > 1, DUPLICATE).when(~F.substring(bare, -1, 1).isin(*ENDS), CUT).otherwise(FINE)
    judged = placed.withColumn("_nth", nth).withColumn("fault", fault).drop("_same", "_nth")
    # Of equal rows of one turn the first is the one that is no duplicate.
    return judged.sortWithinPartitions("conv_id", *order, F.col("fault") == DUPLICATE)


def lightest(rows: list[tuple[str, int]], starts: dict[int, tuple[int, str]], final: bool) -> dict[int, tuple[int, str, int]]:
    """Lightest (cost, audit, state it started from) by state after `rows` (initial, fault); of the goal alone, if it is the end.

    `starts` gives the weights of the states before the first row. The goal has the state -1.
    """
    end = len(rows)
    agenda = [(cost, audit, 0, state, state) for state, (cost, audit) in starts.items()]
    heapq.heapify(agenda)
    finished: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str, int]] = {}
    while agenda:
        cost, audit, place, state, origin = heapq.heappop(agenda)
        if (place, state) in finished:
            continue
        finished.add((place, state))
        if place > end:
            return {-1: (cost, audit, origin)}
        if place == end:
            if not final:
                found[state] = (cost, audit, origin)
                if len(found) == 4:
                    break
            elif state in _FINAL:
                heapq.heappush(agenda, (cost, audit, end + 1, 0, origin))
        made = _MOVES[state, _NEXT[state][0]]
        if (place, made) not in finished:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", place, made, origin))
        if place == end:
            continue
        initial, fault = rows[place]
        heapq.heappush(agenda, (cost + DELETE, audit + "D", place + 1, state, origin))
        if fault in (BLANK, DUPLICATE):
            continue
        stays = cost + (TRUNCATED if fault == CUT else 0)
        heapq.heappush(agenda, (stays + REROLE, audit + "R", place + 1, made, origin))
        kept = _MOVES.get((state, initial))
        if kept is not None:
            heapq.heappush(agenda, (stays + KEEP, audit + "K", place + 1, kept, origin))
    return found


def replayed(rows: list[tuple], state: int, audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves or makes; `rows` begin with role and text."""
    at = 0
    for edit in audit:
        role, text = _NEXT[state], ""
        if edit != "I":
            if edit == "K":
                role = rows[at][0]
            text = rows[at][1]
            at += 1
        if edit != "D":
            yield edit, role, text
            state = _MOVES[state, role[:1]]


def _worth_keeping(found: dict[int, tuple[int, str, int]]) -> dict[int, tuple[int, str, int]]:
    """Without the states that others beat whatever rows follow: after a pair all goes on as after nothing, but that a system turn must
    be deleted, and as after a system turn; one inserted turn leads from a user's turn to a pair and back."""
    cost = {state: weight[0] for state, weight in found.items()}
    far = float("inf")
    pair, user = cost.get(_PAIR, far), cost.get(_USER, far)
    limits = {_EMPTY: pair + DELETE, _SYSTEM: pair, _USER: pair + INSERT, _PAIR: user + INSERT}
    return {state: weight for state, weight in found.items() if cost[state] <= limits[state]}


class Repair:
    """One conversation, row by row: its faults, its lightest repair, and the hash of that."""

    def __init__(self, conv_id: int | None, keep_rows: bool = False) -> None:
        self.conv_id, self.keep_rows = conv_id, keep_rows
        self.counts = {BLANK: 0, DUPLICATE: 0, CUT: 0, FINE: 0}
        self.turns, self.first_turn, self.last_turn, self.illegal, self.before = 0, None, None, 0, None
        self.block: list[tuple[str, str, int]] = []
        # By state: cost, audit beyond what all agree on, hash of the repaired text, whether that has a row.
        self.front = {_EMPTY: (0, "", hashlib.sha256(), False)}
        self.agreed: list[str] = []
        # If rows are kept: those that the undecided audits are about, and the state before them.
        self.open_rows: list[tuple] = []
        self.open_state = _EMPTY
        self.decided: list[tuple[str, str, str]] = []

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.counts[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in _LEGAL
        self.before = initial
        if len(self.block) == BLOCK:
            self._solve(final=False)
        self.block.append((role, text, fault))

    def _solve(self, final: bool) -> None:
        rows = self.block
        starts = {state: (cost, audit) for state, (cost, audit, _, _) in self.front.items()}
        found = lightest([(role[:1], fault) for role, _, fault in rows], starts, final)
        if not final:
            found = _worth_keeping(found)
        agreed = os.path.commonprefix([audit for _, audit, _ in found.values()])
        front = {}
        for state, (cost, audit, origin) in found.items():
            _, tail, hashed, begun = self.front[origin]
            hashed = hashed.copy()
            for _, role, text in replayed(rows, origin, audit[len(tail):]):
                hashed.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            front[state] = (cost, audit[len(agreed):], hashed, begun)
        if self.keep_rows:
            self.open_rows += rows
            made = list(replayed(self.open_rows, self.open_state, agreed))
            self.decided += made
            for _, role, _ in made:
                self.open_state = _MOVES[self.open_state, role[:1]]
            self.open_rows = self.open_rows[len(agreed) - agreed.count("I"):]
        self.front, self.block = front, []
        self.agreed.append(agreed)

    def finish(self) -> tuple:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        self._solve(final=True)
        (cost, rest, hashed, _), = self.front.values()
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        faults = [self.counts[fault] for fault in (BLANK, DUPLICATE, CUT)]
        return self.conv_id, gaps, *faults, self.illegal, cost, "".join([*self.agreed, rest]), hashed.hexdigest()


def _conversations(batches: Iterator[pa.RecordBatch], keep_rows: bool) -> Iterator[tuple[Repair, bool]]:
    """Every conversation of a sorted partition, after each of its rows if rows are kept, and when it has ended."""
    now: Repair | None = None
    for batch in batches:
        for conv_id, turn, role, text, dropped, fault in zip(*[column.to_pylist() for column in batch.columns]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now, True
                now = Repair(conv_id, keep_rows)
            if not dropped:
                now.add(turn, role, text, fault)
                if keep_rows and now.decided:
                    yield now, False
    if now is not None:
        yield now, True


_READ = ("conv_id", "turn", "role", "text", "dropped", "fault")
_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
# Results that a task passes on at once.
_TOGETHER = 4_096


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def repair_conversations(rows: DataFrame, *, damage: bool = False) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` is (conv_id, turn, role, text); with `damage` they are damaged first. Rows are taken by turn, null turns first, those of
    one turn by role and text. Null roles and texts are one blank; a role counts by its first character, so an empty or unknown one is never kept.
    Rows without a conv_id are one conversation. Repeated rows are duplicates of the first. Texts and conversations of any length are read as a
    stream. Of the cheapest repairs the one with the ASCII-least audit is taken, so ties have one result. Other columns are not read. A conversation
    none of whose rows are left has zeros, an empty audit and the hash of nothing. No rows: no rows.
    """
    kind = rows.schema["conv_id"].dataType
    names = ["conv_id", *[c.split()[0] for c in _RESULT.split(", ")]]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for repair, _ in _conversations(batches, False):
            found.append(repair.finish())
            if len(found) == _TOGETHER:
                yield _batch(found, names, kinds)
                found = []
        yield _batch(found, names, kinds)

    ready = _prepared(rows, damage).withColumn("conv_id", F.col("conv_id").cast("bigint"))
    return ready.mapInArrow(of_batches, f"conv_id bigint, {_RESULT}").withColumn("conv_id", F.col("conv_id").cast(kind))


def repaired_rows(rows: DataFrame, *, damage: bool = False) -> DataFrame:
    """(conv_id, place, edit, role, text): the conversations as repaired, places from 0 on, edits K, R or I. Otherwise as repair_conversations.

    A task holds the rows on which the lightest derivations do not agree yet.
    """
    names = ["conv_id", "place", "edit", "role", "text"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, found = 0, []
        for repair, ended in _conversations(batches, True):
            if ended:
                repair.finish()
            found += [(repair.conv_id, place + i, *row) for i, row in enumerate(repair.decided)]
            place = 0 if ended else place + len(repair.decided)
            repair.decided = []
            if len(found) >= _TOGETHER:
                yield _batch(found, names, kinds)
                found = []
        yield _batch(found, names, kinds)

    kind = rows.schema["conv_id"].dataType
    ready = _prepared(rows, damage).withColumn("conv_id", F.col("conv_id").cast("bigint"))
    made = ready.mapInArrow(of_batches, "conv_id bigint, place bigint, edit string, role string, text string")
    return made.withColumn("conv_id", F.col("conv_id").cast(kind))


def _prepared(rows: DataFrame, damage: bool) -> DataFrame:
    """Rows with their faults, placed by conversation and in order."""
    if damage:
        ready = damaged(rows)
    else:
        role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
        ready = rows.select("conv_id", "turn", role, text, F.lit(False).alias("dropped"))
    return with_faults(ready).select(*_READ)
