"""Merkle manifest of a table by time-forward processing.

Every row is a leaf, the SHA-256 of its columns. Per group (a source), leaves in the order
of their id are joined in runs of ``ARITY`` until one node, the group's subroot, is left;
the subroots, in the order of the groups, are joined in the same way to the root.

A node's label is (group, level, place), and children come before parents. In time-forward
processing a node, once made, sends its digest to its parent's label through an external
priority queue, and nodes are made in the order of their labels from the messages that the
queue gives out. Spark's sorted exchange is that external queue: it holds the messages that
go far, to a label in another block, sorted by label and spilled to disk at need. A block
is a subtree over ``BLOCK`` = 3^7 neighbouring nodes of a group; inside it the messages
wait in a heap. So a round takes seven levels at once, and a table of 10^10 rows needs four
rounds. The reversed sweep goes through the same queue by falling label: each node sends
each child the child's siblings and what it got itself, until every leaf has its proof: the
siblings of all levels up to the root.

Texts stay where they are: only (group, id, digest) of each row is exchanged. A hot group
is cut into blocks like any other; a leaf's place in its group is counted over range
partitions, from one small row per partition that comes to the driver. What comes there
beside that is the root and, per round, one count.

Defined results: a null column is a leaf part of its own (``-``). Rows with a null group
are a group of their own, the first. Null ids come before all others; rows of one id are
in the order of their leaves, so rows that repeat are neighbours. An empty table gives an
empty one, without a root. Columns that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import groupby, islice
from operator import and_

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_sql, cut, landed, table

ARITY = 3
LEVELS = 7
BLOCK = ARITY ** LEVELS
ALONE = "."  # a step of a proof without siblings: digests before it, a dot, digests after it


def digest_of(*columns: Column) -> Column:
    """SHA-256 of the columns one after another, each null as ``-`` and any other value as
    its length in UTF-8 bytes, a colon and the value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def _joined(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def forward(digests: list[str]) -> list[list[str]]:
    """The levels of a subtree over ``digests``, the lowest first. The queue gives out
    messages (label of the receiver, place among its children, digest) by label."""
    levels = [digests]
    counts = [len(digests)]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // ARITY))
        levels.append([])
    queue = [((1, i // ARITY), i % ARITY, d) for i, d in enumerate(digests)] if len(counts) > 1 else []
    heapq.heapify(queue)
    while queue:
        (level, place), _, first = heapq.heappop(queue)
        got = [first]
        while queue and queue[0][0] == (level, place):
            got.append(heapq.heappop(queue)[2])
        made = _joined(got)
        levels[level].append(made)
        if level + 1 < len(counts):
            heapq.heappush(queue, ((level + 1, place // ARITY), place % ARITY, made))
    return levels


def backward(levels: list[list[str]], above: str) -> Iterator[str]:
    """For each leaf of a subtree its proof, steps from the leaf to the root joined by
    commas; ``above`` is the proof of the subtree's top. The queue gives out messages
    (label of the receiver, proof) from the highest label to the lowest."""
    queue = [(-(len(levels) - 1), 0, above)]
    while queue:
        level, place, proof = heapq.heappop(queue)
        level = -level
        if not level:
            yield proof
            continue
        low = levels[level - 1]
        first = place * ARITY
        run = low[first:first + ARITY]
        for k in range(len(run)):
            step = f"{''.join(run[:k])}{ALONE}{''.join(run[k + 1:])}"
            heapq.heappush(queue, (1 - level, first + k, f"{step},{proof}" if proof else step))


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    for step in proof.split(",") if proof else ():
        before, after = step.split(ALONE)
        leaf = _joined([before, leaf, after])
    return leaf


def siblings_digest(proof: str) -> str:
    return sha256(proof.replace(ALONE, "").replace(",", "").encode()).hexdigest()


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``i``, a row's place in its ``group`` by ``order``, counted from 0."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order, "_m"]  # the last parts rows that are equal in all others
    rows = cut(df.withColumn("_m", F.monotonically_increasing_id())
               .repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_m"))
    at = rows.columns.index(group)

    def border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        runs = n_first = n_last = 0
        for batch in batches:
            for g, run in groupby(batch.column(at).to_pylist()):
                n = sum(1 for _ in run)
                if runs and g == last:
                    n_last += n
                else:
                    last, n_last, runs = g, n, runs + 1
                    first = g if runs == 1 else first
                if runs == 1:
                    n_first = n_last
        if runs:
            yield pa.RecordBatch.from_pylist([{"p": TaskContext.get().partitionId(), "first": first, "last": last,
                                               "n": n_last, "one": runs == 1}],
                                             schema=pa.schema([("p", pa.int32()), ("first", pa.string()), ("last", pa.string()),
                                                               ("n", pa.int64()), ("one", pa.bool_())]))

    offset, before = {}, None
    for r in sorted(rows.mapInArrow(border, "p int, first string, last string, n long, one boolean").collect()):
        offset[r.p] = before[1] if before and before[0] == r.first else 0
        before = (r.last, r.n + (offset[r.p] if r.one else 0))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, i = None, offset.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            places = []
            for g, run in groupby(batch.column(at).to_pylist()):
                if held is not None and held[0] != g:
                    i = 0
                held = (g,)
                n = sum(1 for _ in run)
                places += range(i, i + n)
                i += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "i"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(number, f"{schema}, i long")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of one block together and in order; one block after the other."""
    return rows.repartition("g", "b").sortWithinPartitions("g", "b", "i")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    rows = (r for batch in batches for r in batch.to_pylist())
    return ((key, list(run)) for key, run in groupby(rows, key=lambda r: (r["g"], r["b"])))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, 1024)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


TOPS = pa.schema([("g", pa.string()), ("b", pa.int64()), ("height", pa.int32()), ("top", pa.string()), ("full", pa.string())])
PROOFS = pa.schema([("g", pa.string()), ("b", pa.int64()), ("proof", pa.string())])
CHECKED = pa.schema([(c, pa.int64() if c == "id" else pa.string())
                     for c in ("g", "id", "d", "subroot", "proof_sha256", "folded_root")])


def _up(nodes: DataFrame) -> DataFrame:
    """(g, b, height, top, full) of each block of ``nodes`` (g, i, d): its top node, and what
    becomes of it at the level where blocks meet, after runs of one."""
    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (g, b), rows in _runs(batches):
            levels = forward([r["d"] for r in rows])
            top = full = levels[-1][0]
            for _ in range(LEVELS + 1 - len(levels)):
                full = _joined([full])
            yield g, b, len(levels) - 1, top, full

    return _blocks(nodes.select("g", F.expr(f"i div {BLOCK}").alias("b"), "i", "d")).mapInArrow(
        lambda batches: _batches(tops(batches), TOPS), "g string, b long, height int, top string, full string")


def _down(nodes: DataFrame, above: DataFrame, leaves: bool) -> DataFrame:
    """The proof of each node as (g, b, proof); ``above`` (g, b, proof, subroot) has those of
    the blocks' tops. Of leaves, what their proofs give instead (``CHECKED``)."""
    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (g, _), rows in _runs(batches):
            top, rows = rows[0], rows[1:]
            for r, proof in zip(rows, backward(forward([r["d"] for r in rows]), top["proof"])):
                if leaves:
                    yield g, r["id"], r["d"], top["subroot"], siblings_digest(proof), fold(r["other"] or r["d"], proof)
                else:
                    yield g, r["i"], proof

    both = nodes.withColumn("b", F.expr(f"i div {BLOCK}")).unionByName(
        above.withColumn("i", F.lit(-1).cast("long")), allowMissingColumns=True)
    schema = CHECKED if leaves else PROOFS
    return _blocks(both).mapInArrow(lambda batches: _batches(proofs(batches), schema), ", ".join(
        f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in schema))


def _with(rows: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Join on ``keys``, null being equal to null."""
    named = other.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in other.columns])
    return rows.join(named, reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))).drop(*[f"_{k}" for k in keys])


def _ascend(nodes: DataFrame, name: str) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Rounds of (nodes, their blocks), and (g, d): the last node of each group."""
    rounds, done = [], []
    while True:
        tops = landed(_up(nodes), f"merkle-{name}")
        last = tops.groupBy("g").agg((F.max("b") > 0).alias("goes_on"))
        blocks = landed(_with(tops, last, "g"), f"merkle-{name}-blocks")
        rounds.append((nodes, blocks))
        done.append(blocks.where("not goes_on").select("g", F.col("top").alias("d")))
        nodes = blocks.where("goes_on").select("g", F.col("b").alias("i"), F.col("full").alias("d"))
        if nodes.isEmpty():
            return rounds, reduce(DataFrame.union, done)


def _descend(rounds: list[tuple[DataFrame, DataFrame]], ends: DataFrame) -> DataFrame:
    """``_down`` of the first round's nodes; ``ends`` (g, proof, subroot) has the proofs of
    the groups' last nodes, with a null subroot where nodes are not leaves."""
    found = None
    for k, (nodes, blocks) in reversed(list(enumerate(rounds))):
        ending = _with(blocks.where("not goes_on"), ends, "g").select("g", "b", "proof", "subroot")
        if found is not None:
            # from a block's top to the level where blocks meet: runs of one
            lift = F.array_repeat(F.lit(ALONE), F.lit(LEVELS) - F.col("height"))
            above = _with(_with(blocks.where("goes_on"), found, "g", "b"), ends.select("g", "subroot"), "g")
            ending = ending.union(above.select("g", "b", F.array_join(F.concat(lift, F.array("proof")), ",").alias("proof"),
                                               "subroot"))
        found = _down(nodes, ending, leaves=k == 0 and "id" in nodes.columns)
        if k:
            found = landed(found, "merkle-proofs")
    return found


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g string, id long, d: the leaf's digest, other: the digest to fold in its
    stead, or null). Per leaf: g, id, d, subroot, proof_sha256 (of the siblings' digests from
    the leaf to the root), folded_root (from ``other`` or d, and the siblings), root."""
    nodes = landed(numbered(leaves.select("g", "id", "d", "other"), "g", ["id", "d"]), "merkle-leaves")
    if nodes.isEmpty():
        return leaves.select("g", "id", "d", *[F.lit("").alias(c) for c in (*CHECKED.names[3:], "root")]).limit(0)
    rounds, ends = _ascend(nodes, "leaves")
    # the subroots are the leaves of one more tree; its only group has an empty name
    subroots = landed(numbered(ends.select(F.lit("").alias("all"), F.col("g").alias("name"), "d"), "all", ["name"]), "merkle-subroots")
    over, top = _ascend(subroots.select(F.col("all").alias("g"), "i", "d"), "groups")
    root = top.first().d
    above = _descend(over, top.select("g", F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot")))
    proofs = subroots.join(above.select(F.col("b").alias("i"), "proof"), "i").select(
        F.col("name").alias("g"), "proof", F.col("d").alias("subroot"))
    return _descend(rounds, landed(proofs, "merkle-above")).withColumn("root", F.lit(root))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: leaf, roots, proof and a check of every document; of every second the line
    ends are tampered with."""
    docs = table(spark, sf_dir, "documents")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = docs.select(
        F.col("source").cast("string").alias("g"), F.col("doc_id").cast("long").alias("id"),
        digest_of(*first, F.col("text")).alias("d"),
        F.when(half & F.col("text").contains("\n"), digest_of(*first, F.replace("text", F.lit("\n"), F.lit("")))).alias("other"))
    return manifest(leaves).select(
        F.col("id").alias("doc_id"), F.col("d").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _part(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


SQL = f"""
WITH RECURSIVE z AS (SELECT source, doc_id, sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
                  sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')"))}) AS other,
                  {crc32_sql("doc_id::VARCHAR")} % 2 = 0 AS half FROM documents),
l AS (SELECT doc_id, source, leaf, CASE WHEN half THEN other ELSE leaf END AS seen,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM z),
n AS (SELECT source, 0 AS lv, i, leaf AS d, count(*) OVER (PARTITION BY source) AS many FROM l
      UNION ALL SELECT source, lv + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), any_value(many + 2) // 3
                FROM n WHERE many > 1 GROUP BY source, lv, i // 3),
g AS (SELECT source, lv AS height, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM n WHERE many = 1),
t AS (SELECT 0 AS lv, i, subroot AS d, count(*) OVER () AS many FROM g
      UNION ALL SELECT lv + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), any_value(many + 2) // 3 FROM t WHERE many > 1 GROUP BY lv, i // 3),
root AS (SELECT lv AS height, d AS root FROM t WHERE many = 1),
s AS (SELECT l.doc_id, l.leaf, n.lv AS step, coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i < l.i // p.w), '') AS before,
             coalesce(string_agg(n.d, '' ORDER BY n.i) FILTER (n.i > l.i // p.w), '') AS after
      FROM l JOIN n ON n.source IS NOT DISTINCT FROM l.source, LATERAL (SELECT (3 ** n.lv)::BIGINT AS w) p
      WHERE n.many > 1 AND n.i // 3 = l.i // p.w // 3 GROUP BY 1, 2, 3
      UNION ALL
      SELECT l.doc_id, l.leaf, g.height + t.lv, coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i < g.i // p.w), ''),
             coalesce(string_agg(t.d, '' ORDER BY t.i) FILTER (t.i > g.i // p.w), '')
      FROM l JOIN g ON g.source IS NOT DISTINCT FROM l.source, t, LATERAL (SELECT (3 ** t.lv)::BIGINT AS w) p
      WHERE t.many > 1 AND t.i // 3 = g.i // p.w // 3 GROUP BY 1, 2, 3),
f AS (SELECT doc_id, leaf, 0 AS step, seen AS d FROM l
      UNION ALL SELECT f.doc_id, f.leaf, f.step + 1, sha256(s.before || f.d || s.after) FROM f JOIN s USING (doc_id, leaf, step)),
e AS (SELECT doc_id, leaf, arg_max(d, step) AS folded_root FROM f GROUP BY 1, 2),
q AS (SELECT doc_id, leaf, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM s GROUP BY 1, 2)
SELECT l.doc_id, l.leaf, g.subroot, root.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = root.root AS verified
FROM l JOIN g ON g.source IS NOT DISTINCT FROM l.source JOIN e USING (doc_id, leaf) LEFT JOIN q USING (doc_id, leaf), root
"""
