"""Chat formatting: minimum-cost repair of roles over a legal-turn automaton.

A legal conversation has an optional system turn, then user and assistant in turn, the
assistant last. Every turn is kept, relabelled or merged into the turn before it, and empty
turns may be inserted; dynamic programming over the automaton's states finds the cheapest
choice, and the repaired turns are rendered.

A conversation may be longer than a task's share. Turns are dealt by ranges of conversation
and turn, and a conversation that crosses tasks is joined by small tables: for each piece
the cost from every state to every state (min-plus matrices), then the state in which each
piece is entered for every state in which it is left. The driver gets two such tables of 4 x 4
numbers for each partition, never turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import checkpointed

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = (None, "system", "user", "assistant")
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
FAR = 1 << 40


class Costs(NamedTuple):
    """Price of each repair; keeping a turn is free."""

    relabel: int = 3
    merge_same: int = 1
    merge_other: int = 4
    insert: int = 2


class Move(NamedTuple):
    """One way from a state to another for a turn."""

    before: int
    after: int
    cost: int
    action: str
    inserted: tuple[int, ...]


def between(before: int, role: int) -> tuple[int, ...] | None:
    """Empty turns needed to write `role` after `before`; None where nothing helps."""
    if role == SYSTEM:
        return () if before == START else None
    if role == USER:
        return (ASSISTANT,) if before == USER else ()
    return () if before == USER else (USER,)


def ending(before: int) -> tuple[int, ...]:
    """Empty turns needed to end after `before`."""
    return {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}[before]


def moves(role: int | None, costs: Costs) -> list[Move]:
    """All ways to handle a turn of a role (None: unknown), those preferred among equals first."""
    out = []
    for before in range(4):
        for label in (SYSTEM, USER, ASSISTANT):
            empty = between(before, label)
            if empty is not None:
                kept = label == role
                out.append(Move(before, label, (0 if kept else costs.relabel) + costs.insert * len(empty), "keep" if kept else "relabel", empty))
        if before != START:
            out.append(Move(before, before, costs.merge_same if before == role else costs.merge_other, "merge", ()))
    order = {"keep": 0, "merge": 1, "relabel": 2}
    return sorted(out, key=lambda m: (order[m.action], m.before, m.after))


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    return ROLES.get(ALIASES.get(name, name))


class Repair:
    """Dynamic programming over the turns of one piece of a conversation."""

    def __init__(self, costs: Costs):
        self.moves = {role: moves(role, costs) for role in (None, SYSTEM, USER, ASSISTANT)}
        self.insert = costs.insert

    def forward(self, roles: list[int | None], entry: list[int]) -> tuple[list[int], np.ndarray]:
        """Cost of every state after the piece, and each turn's best move into every state."""
        best, back = list(entry), np.full((len(roles), 4), -1, np.int8)
        for i, role in enumerate(roles):
            after = [FAR] * 4
            for k, m in enumerate(self.moves[role]):
                cost = best[m.before] + m.cost
                if cost < after[m.after]:
                    after[m.after] = cost
                    back[i, m.after] = k
            best = after
        return best, back

    def matrix(self, roles: list[int | None]) -> list[list[int]]:
        """Cost from every state before the piece to every state after it."""
        return [self.forward(roles, [0 if s == e else FAR for s in range(4)])[0] for e in range(4)]

    def path(self, roles: list[int | None], back: np.ndarray, last: int) -> tuple[int, list[Move]]:
        """State before the piece and the moves that end in state `last`."""
        out = []
        for i in range(len(roles) - 1, -1, -1):
            move = self.moves[roles[i]][back[i, last]]
            out.append(move)
            last = move.before
        return last, out[::-1]

    def end(self, best: list[int]) -> int:
        """The state to end in."""
        return min(range(4), key=lambda s: (min(best[s], FAR) + self.insert * len(ending(s)), s))


def render(move: Move, text: str) -> str:
    """What a turn adds to the rendered conversation."""
    if move.action == "merge":
        return f"\n\n{text}"
    opened = "".join(f"<|{NAMES[r]}|>\n<|end|>\n" for r in move.inserted)
    close = "" if move.before == START else "<|end|>\n"
    return f"{close}{opened}<|{NAMES[move.after]}|>\n{text}"


def close(last: int) -> str:
    """What ends a rendered conversation."""
    return "<|end|>\n" + "".join(f"<|{NAMES[r]}|>\n<|end|>\n" for r in ending(last))


class Piece(NamedTuple):
    """A conversation's turns within one partition."""

    key: str | None
    turns: list[tuple]


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    held: Piece | None = None
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if held is None or held.key != row[0]:
                if held is not None:
                    yield held
                held = Piece(row[0], [])
            held.turns.append(row)
    if held is not None:
        yield held


def edges(found: Iterator[Piece]) -> Iterator[tuple[int, bool, Piece]]:
    """Number of each piece in its partition, and whether it is the first or last one there."""
    held, n = None, 0
    for piece in found:
        if held is not None:
            yield n, n == 0, held
            n += 1
        held = piece
    if held is not None:
        yield n, True, held


def repair(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs = Costs(),
) -> DataFrame:
    """Every turn with its repair: conv_id, turn, role, action, new_role, inserted, cost, rendered.

    `inserted` counts the empty turns put before a turn, and after the last one of a
    conversation; the `cost`s of a conversation add up to the least possible. `rendered`
    is what the turn adds: the pieces of a conversation, in order, are its chat text.
    Turns are ordered by number (null first), then role and a hash of the text; both ids are of
    any type that can be ordered. A null or unknown role fits
    no label free of charge; a null text is empty. Rows with a null conversation are one
    conversation. Repeated rows are turns of their own; an empty table gives no rows.
    """
    kinds = dict(turns.dtypes)
    arrow = {f.name: to_arrow_type(f.dataType) for f in turns.schema if f.name in (conv, turn)}
    order = ["key", "turn", "role", F.xxhash64("text")]
    rows = turns.select(F.col(conv).alias("key"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    # kept as dealt: all passes below must see the same pieces
    dealt = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    plan = Repair(costs)

    def part_id() -> int:
        from pyspark import TaskContext

        return TaskContext.get().partitionId()

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for n, edge, piece in edges(pieces(batches)):
            if edge:
                flat = np.array(plan.matrix([role_of(t[2]) for t in piece.turns]), np.int64).ravel()
                out.append((part_id(), n, piece.turns[0][0], flat.tolist()))
        if out:
            key_kind = arrow[conv]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), key_kind, pa.list_(pa.int64())))], ["part", "n", "key", "matrix"]
            )

    # one or two rows for each partition
    crossing = dealt.mapInArrow(first_pass, f"part int, n long, key {kinds[conv]}, matrix array<long>").orderBy("part", "n").collect()
    entry, last = {}, set()
    for i, r in enumerate(crossing):
        joined = i > 0 and crossing[i - 1].key == r.key and crossing[i - 1].part != r.part
        if joined:
            before = crossing[i - 1]
            cost = np.array(entry[before.part, before.n])[:, None] + np.array(before.matrix).reshape(4, 4)
            entry[r.part, r.n] = np.minimum(cost.min(axis=0), FAR).tolist()
        else:
            entry[r.part, r.n] = [0, FAR, FAR, FAR]
            if i:
                last.add((crossing[i - 1].part, crossing[i - 1].n))
    if crossing:
        last.add((crossing[-1].part, crossing[-1].n))
    alone = [0, FAR, FAR, FAR]

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = [], part_id()
        for n, edge, piece in edges(pieces(batches)):
            if edge:
                roles = [role_of(t[2]) for t in piece.turns]
                best, back = plan.forward(roles, entry[part, n])
                ways = [plan.path(roles, back, s)[0] if best[s] < FAR else -1 for s in range(4)]
                out.append((part, n, ways, plan.end(best)))
        if out:
            columns = zip(zip(*out), (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["part", "n", "ways", "end"])

    ways = dealt.mapInArrow(second_pass, "part int, n long, ways array<long>, end long").orderBy("part", "n").collect()
    leave: dict[tuple[int, int], int] = {}
    state = 0
    for r in reversed(ways):
        state = r.end if (r.part, r.n) in last else state
        leave[r.part, r.n] = state
        state = r.ways[state]

    def third_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = part_id(), []

        def batch_of(rows: list) -> pa.RecordBatch:
            own = (arrow[conv], arrow[turn], pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string())
            names = ["conv_id", "turn", "role", "action", "new_role", "inserted", "cost", "rendered"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), own)], names)

        for n, edge, piece in edges(pieces(batches)):
            roles = [role_of(t[2]) for t in piece.turns]
            best, back = plan.forward(roles, entry[part, n] if edge else alone)
            end = leave[part, n] if edge else plan.end(best)
            whole = not edge or (part, n) in last
            done = plan.path(roles, back, end)[1]
            for i, (row, move) in enumerate(zip(piece.turns, done)):
                key, number, name, value = row
                inserted, cost, shown = len(move.inserted), move.cost, render(move, value or "")
                if whole and i == len(done) - 1:
                    inserted += len(ending(end))
                    cost += costs.insert * len(ending(end))
                    shown += close(end)
                out.append((key, number, name, move.action, NAMES[move.after], inserted, cost, shown))
                if len(out) >= 2000:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    schema = f"conv_id {kinds[conv]}, turn {kinds[turn]}, role string, action string, new_role string, inserted int, cost long, rendered string"
    return dealt.mapInArrow(third_pass, schema)
