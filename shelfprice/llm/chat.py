"""Chat formatting with minimum-cost role repair.

A legal conversation is accepted by a small automaton: an optional system turn, then
user and assistant turns in alternation, user first, assistant last. An input turn may be
kept, relabelled, merged into the turn before it (also relabelled, if the roles differ),
and empty turns may be inserted before it or at the end, each at a cost. Dynamic
programming over the automaton's states finds the cheapest repair; of equally cheap ones
it takes, from the end backwards, the earlier state in the order of ``STATES`` and the
earlier of keep or relabel, merge. The repaired sequence is rendered with start and end
marks, which are broken up where they stand in a text.

Turns are ordered by turn, role, then a hash of the text (nulls first) and dealt out by range, so that a
conversation of any length is cut into segments. Costs of a segment are a matrix over the
states, and matrices multiply by (min, +): pass 1 gives the matrices of the segments at
partition borders, whose products give each segment's entry costs; pass 2 gives, from
those, which entry state each exit state leads to; pass 3 labels and renders. What comes
to the driver between passes is two small rows per partition. The rendered text is
returned turn by turn (``rendered``), so no conversation is ever one value; a
conversation's text is these pieces in the order of ``position``.

Defined results: rows with a null conv_id are one conversation. A null or unknown role
must be relabelled, for ``UNKNOWN``. A null text counts as empty. Repeated rows are turns
of their own, equal neighbours in the order. An empty table gives an empty one. Columns other
than the four of a conversation are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table

STATES = ("start", "system", "user", "assistant")
LEGAL = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
ACCEPT = ("assistant",)
MERGE, INSERT, RELABEL, UNKNOWN = 1, 2, 3, 1
FAR = 1 << 40
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KEEP, JOIN = 0, 1


def _inserts() -> dict[tuple[int, int], tuple[str, ...]]:
    """The fewest empty turns that lead from one state to another."""
    out: dict[tuple[int, int], tuple[str, ...]] = {(s, s): () for s in range(4)}
    for _ in range(4):
        for (s, m), path in sorted(out.items()):
            for role in LEGAL[STATES[m]]:
                out.setdefault((s, STATES.index(role)), (*path, role))
    return out


PATHS = _inserts()
END = [min((INSERT * len(PATHS[s, STATES.index(a)]), STATES.index(a)) for a in ACCEPT if (s, STATES.index(a)) in PATHS)
       for s in range(4)]


def _step(role: str | None) -> tuple[list[list[int]], list[list[tuple]]]:
    """Cost of going from state to state over one input turn, and how."""
    cost = [[FAR] * 4 for _ in range(4)]
    how: list[list[tuple]] = [[()] * 4 for _ in range(4)]
    known = role in STATES[1:]
    for s in range(4):
        for t in range(1, 4):
            label = 0 if STATES[t] == role else RELABEL if known else UNKNOWN
            options = [(INSERT * len(PATHS[s, m]) + label, KEEP, PATHS[s, m]) for m in range(4)
                       if (s, m) in PATHS and STATES[t] in LEGAL[STATES[m]]]
            if s == t:
                options.append((MERGE + label, JOIN, ()))
            if options:
                cost[s][t], *rest = min(options)
                how[s][t] = tuple(rest)
    return cost, how


STEPS = {role: _step(role) for role in (*STATES[1:], None)}


def _of(role: str | None) -> str | None:
    return role if role in STEPS else None


def forward(entry: list[int], roles: list[str | None], back: bytearray | None = None) -> list[int]:
    """Costs after the turns, by state; ``back`` gets the state before, by turn and state."""
    now = entry
    for role in roles:
        cost = STEPS[_of(role)][0]
        after = []
        for t in range(4):
            best, source = min((now[s] + cost[s][t], s) for s in range(4))
            after.append(min(best, FAR))
            if back is not None:
                back.append(source)
        now = after
    return now


def backward(back: bytearray, end: int) -> list[int]:
    """States before and after each turn, for the state after the last."""
    path = [end]
    for i in range(len(back) // 4 - 1, -1, -1):
        path.append(back[4 * i + path[-1]])
    return path[::-1]


def last_state(costs: list[int]) -> int:
    return min((costs[s] + END[s][0], s) for s in range(4))[1]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[pa.RecordBatch, int, int]]]]:
    """Runs of rows of one conversation: (conv_id, slices of batches)."""
    held, key = [], None
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        at = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[at]:
                if held and ids[at] != key:
                    yield key, held
                    held = []
                key = ids[at]
                held.append((batch, at, i - at))
                at = i
    if held:
        yield key, held


def _roles(held: list) -> list[str | None]:
    return [r for b, at, n in held for r in b.column("role").slice(at, n).to_pylist()]


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, object, list]]:
    """The first and the last segment of a partition (number 0 and 1; 0 if they are one)."""
    first, last = None, None
    for key, held in _segments(batches):
        if first is None:
            first = (0, key, held)
        else:
            last = (1, key, held)
    yield from (x for x in (first, last) if x)


def _plan(turns: DataFrame) -> tuple[dict, dict]:
    """For segments at partition borders: entry costs, and the exit state (None where
    the conversation ends in the segment)."""
    part = turns.select("conv_id", "role")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        rows = [{"pid": pid, "number": n, "conv_id": str(key), "cells": [
            c for s in range(4) for c in forward([0 if x == s else FAR for x in range(4)], _roles(held))]}
            for n, key, held in _at_borders(batches)]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("pid", pa.int32()), ("number", pa.int32()), ("conv_id", pa.string()), ("cells", pa.list_(pa.int64()))]))

    rows = sorted((r.pid, r.number, r.conv_id, list(r.cells)) for r in part.mapInArrow(
        matrices, "pid int, number int, conv_id string, cells array<long>").collect())
    start = [0, FAR, FAR, FAR]
    entry, goes_on, before = {}, set(), None
    for pid, number, conv, cells in rows:
        costs = start
        if before and before[0] == conv and (pid, number) != before[1] and pid != before[1][0]:
            costs = before[2]
            goes_on.add(before[1])
        entry[pid, number] = costs
        after = [min(FAR, min(costs[s] + cells[4 * s + t] for s in range(4))) for t in range(4)]
        before = (conv, (pid, number), after)
    cut_off = {k for k in entry if entry[k] != start or k in goes_on}
    wanted = {k: entry[k] for k in cut_off}

    def sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, rows = TaskContext.get().partitionId(), []
        for n, _, held in _at_borders(batches):
            if (pid, n) in wanted:
                back = bytearray()
                costs = forward(wanted[pid, n], _roles(held), back)
                rows.append({"pid": pid, "number": n, "last": last_state(costs),
                             "source": [backward(back, t)[0] for t in range(4)]})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("pid", pa.int32()), ("number", pa.int32()), ("last", pa.int32()), ("source", pa.list_(pa.int32()))]))

    leave: dict[tuple[int, int], int | None] = {}
    if wanted:
        found = {(r.pid, r.number): r for r in part.mapInArrow(
            sources, "pid int, number int, last int, source array<int>").collect()}
        state = None
        for k in sorted(found, reverse=True):
            leave[k] = state if k in goes_on else None
            end = leave[k] if k in goes_on else found[k]["last"]
            state = found[k]["source"][end]
    return wanted, leave


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per input turn: conv_id, turn, role, position (orders the turns of a
    conversation), new_role, action (keep, relabel, merge, merge+relabel), inserted_before,
    inserted_after (roles of empty turns), cost, rendered."""
    spark = df.sparkSession
    turns = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
                      F.col(text).alias("text"), F.monotonically_increasing_id().alias("_m"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key parts rows that are equal in all others; in which order is of no effect
    turns = cut(turns.repartitionByRange(parts, "conv_id", "turn", "role", F.xxhash64("text"), "_m")
                .sortWithinPartitions("conv_id", "turn", "role", F.xxhash64("text"), "_m").drop("_m"))
    entry, leave = _plan(turns)
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", kind), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("position", T.LongType()), T.StructField("new_role", T.StringType()),
        T.StructField("action", T.StringType()), T.StructField("inserted_before", T.ArrayType(T.StringType())),
        T.StructField("inserted_after", T.ArrayType(T.StringType())), T.StructField("cost", T.LongType()),
        T.StructField("rendered", T.StringType())])

    def shown(s: str | None) -> str:
        return (s or "").replace(OPEN, "<| im_start |>").replace(CLOSE, "<| im_end |>")

    def empty(roles: tuple[str, ...]) -> str:
        return "".join(f"{OPEN}{r}\n{CLOSE}\n" for r in roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, place = TaskContext.get().partitionId(), TaskContext.get().partitionId() << 40
        numbered = ((0 if i == 0 else None, key, held) for i, (key, held) in enumerate(_segments(batches)))
        waiting = next(numbered, None)
        while waiting is not None:
            following = next(numbered, None)
            number, key, held = waiting
            border = (pid, 0) if number == 0 else (pid, 1) if following is None else None
            roles, back = _roles(held), bytearray()
            start = entry.get(border, [0, FAR, FAR, FAR])
            costs = forward(start, roles, back)
            ends = leave.get(border) is None
            path = backward(back, last_state(costs) if ends else leave[border])
            i = 0
            for batch, at, n in held:
                made: dict[str, list] = {c: [] for c in schema.names[3:]}
                for text in batch.column("text").slice(at, n).to_pylist():
                    s, t, r = path[i], path[i + 1], roles[i]
                    cost, how = STEPS[_of(r)]
                    action, inserted = how[s][t]
                    same = STATES[t] == r
                    new = STATES[t]
                    final = ends and i == len(roles) - 1
                    added = PATHS[t, END[t][1]] if final else ()
                    if action == JOIN:
                        piece = f"\n{shown(text)}"
                    else:
                        piece = (f"{CLOSE}\n" if s else "") + empty(inserted) + f"{OPEN}{new}\n{shown(text)}"
                    if final:
                        piece += f"{CLOSE}\n" + empty(added)
                    made["position"].append(place + i)
                    made["new_role"].append(new)
                    made["action"].append(("keep" if same else "relabel") if action == KEEP
                                          else "merge" if same else "merge+relabel")
                    made["inserted_before"].append(list(inserted))
                    made["inserted_after"].append(list(added))
                    made["cost"].append(cost[s][t] + INSERT * len(added))
                    made["rendered"].append(piece)
                    i += 1
                kinds = {"position": pa.int64(), "cost": pa.int64(), "inserted_before": pa.list_(pa.string()),
                         "inserted_after": pa.list_(pa.string())}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, n) for c in ("conv_id", "turn", "role")]
                    + [pa.array(v, kinds.get(c, pa.string())) for c, v in made.items()], names=schema.names)
            waiting = following

    return turns.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every turn of every conversation, repaired and rendered."""
    return repair(table(spark, sf_dir, "conversations")).drop("position")
