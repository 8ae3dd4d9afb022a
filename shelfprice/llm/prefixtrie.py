"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns (role, text); the conversations that start with
it are its members. From the greatest depth down to the root, the conversations that end at
a depth are merged with the nodes that survived from below; then each loses its last turn,
and those that have become equal are one node of the depth above. So nodes are found and
aggregated in the same pass, and no prefix is ever spelled out more than once.

1. Each conversation becomes one narrow row: per turn a 128-bit hash and a length. Equal
   conversations are merged first, so a conversation in a third of all rows is one row
   with a count; its ids are kept in packs of ``PACK`` consecutive numbers.
2. The distinct ones are dealt out by ranges of their turns' hashes, so that those with equal
   beginnings are neighbours. A first turn that a third of all share is cut into ranges like
   any other. A task takes its range in units of up to ``UNIT`` turns and peels each. In a
   sorted unit the members of a node are neighbours, too, and two neighbours belong to one
   node of a depth if their common prefix is as long.
3. Nodes on the way to a unit's first or last row may go on in another unit. A unit gives its
   share of them, which are aggregated by (depth, hash of the turns). They are peeled once
   more, in one pass by falling depth: two paths a unit, whatever the corpus.
4. Nodes of a unit whose parent is such a node get its number by a join.

Turns are ordered by turn (null first), then role and a hash of role and text, so repeated
turns have one order.

Defined results: a null role or text counts as empty. Rows with a null conv_id are no
conversation and are left out. Other columns are ignored, whatever their names. An empty
table gives an empty one (without a root). A conversation of any length is one row of 20
bytes a turn; texts of any length are hashed where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_sql, join_spread, landed, table

PACK = 1 << 16
UNIT = 1 << 19
EMPTY = sha256(b"").hexdigest()
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODES = pa.schema([("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()),
                   ("parent_conv_id", pa.int64()), *[(c, pa.int64()) for c in SUMS], ("last", pa.int64()), ("ends_sha256", pa.string())])
DDL = ("depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, "
       "n_leaves long, saved_tokens long, last long, ends_sha256 string")


def conversations(df: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (a, b: their hash, n:
    code points of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"),
                 F.length(text).alias("n")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("turns"))


def _classes(convs: DataFrame) -> DataFrame:
    """Distinct conversations: (k1, k2, conv_id: the smallest, n: how many, ends: SHA-256 of
    the ascending ids joined by commas)."""
    packs = convs.groupBy("k1", "k2", F.expr(f"conv_id div {PACK}").alias("pack")).agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
        F.min("conv_id").alias("conv_id"))
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("conv_id", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if held is None or held[:2] != [r["k1"], r["k2"]]:
                    if held is not None:
                        out.append((*held[:4], held[4].hexdigest()))
                    held = [r["k1"], r["k2"], r["conv_id"], 0, sha256()]
                elif held[3]:
                    held[4].update(b",")
                held[3] += r["n"]
                held[2] = min(held[2], r["conv_id"])
                held[4].update(r["ids"].encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*held[:4], held[4].hexdigest()), schema)], schema=schema)

    # the hash of a list runs over it in order: one task takes the packs of a class, one at a time
    return (packs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "pack")
            .mapInArrow(run, "k1 long, k2 long, conv_id long, n long, ends string"))


def common_prefixes(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row but the first, how many tokens it has in common with the row before;
    -1 for the first. ``tokens``: those of all rows, one after the other."""
    out = np.full(len(ends), -1, np.int64)
    begin = ends - np.diff(ends, prepend=0)
    for i in range(1, len(ends)):
        a, b = tokens[begin[i - 1]:ends[i - 1]], tokens[begin[i]:ends[i]]
        m = min(len(a), len(b))
        differ = np.flatnonzero((a[:m] != b[:m]).any(1))
        out[i] = differ[0] if len(differ) else m
    return out


def peel(tokens: np.ndarray, size: np.ndarray, ends: np.ndarray, conv: np.ndarray, n: np.ndarray,
         digest: list[str]) -> Iterator[dict[str, list]]:
    """The nodes of a unit, depth by depth, as columns of ``NODES``. Rows (``ends``: where
    each one's turns end in ``tokens`` and ``size``) are sorted and distinct. ``key`` is given
    for nodes that the first or last row belongs to: of those, the sums don't count what
    such a node below has; ``parent_key`` is given for other nodes with such a parent."""
    rows = len(ends)
    length = np.diff(ends, prepend=0)
    begin = ends - length
    common = common_prefixes(tokens, ends)
    keys: list[list[bytes]] = [[], []]
    for side, row in enumerate((0, rows - 1)):
        state = blake2b(digest_size=16)
        keys[side].append(state.digest())
        for turn in tokens[begin[row]:ends[row]]:
            state.update(turn.tobytes())
            keys[side].append(state.digest())
    by_length = np.argsort(length, kind="stable")
    at = np.searchsorted(length[by_length], np.arange(length.max() + 2))
    none = np.zeros(0, np.int64)
    # what survived from the depth below: first row, members, smallest id, then sums of the node
    first, border = none, np.zeros(0, bool)
    live = {c: none for c in (*SUMS, "conv_id")}
    waiting: dict[str, list] = {}
    for depth in range(int(length.max()), -1, -1):
        ended = by_length[at[depth]:at[depth + 1]]
        order = np.argsort(np.append(first, ended), kind="stable")
        at_row = np.append(first, ended)[order]
        below = np.append(np.ones(len(first), bool), np.zeros(len(ended), bool))[order]
        inner = below & ~np.append(border, np.zeros(len(ended), bool))[order]

        def column(name: str, own: np.ndarray) -> np.ndarray:
            return np.append(live[name], own)[order]
        new = np.flatnonzero(common[at_row] < depth)
        group = np.cumsum(common[at_row] < depth) - 1
        members = np.add.reduceat(column("n_convs", n[ended]), new)
        least = np.minimum.reduceat(column("conv_id", conv[ended]), new)
        zero = np.zeros(len(ended), np.int64)
        children = np.add.reduceat(inner.astype(np.int64), new)
        leaves = np.add.reduceat(np.where(inner, column("n_leaves", zero), 0), new)
        saved = np.add.reduceat(np.where(inner, column("saved_tokens", zero), 0), new)
        top = at_row[new]
        starts, goes_on = top == 0, np.zeros(len(new), bool)
        goes_on[-1] = length[-1] >= depth and bool((common[top[-1] + 1:] >= depth).all())
        edge = starts | goes_on
        ender = np.full(len(new), -1, np.int64)
        ender[group[~below]] = at_row[~below]
        turn_size = size[begin[top] + depth - 1] if depth else np.zeros(len(new), np.int64)
        if waiting:
            # nodes of the depth below have lost their last turn and know their parent
            parent = group[below]
            waiting["parent_conv_id"] = [None if e else int(p) for p, e in zip(least[parent], edge[parent])]
            waiting["parent_key"] = [keys[0 if starts[p] else 1][depth] if edge[p] else None for p in parent]
            yield waiting
        childless = (children == 0) & ~np.bincount(group[below & ~inner], minlength=len(new)).astype(bool)
        inside = ~edge
        leaves = np.where(inside & childless, 1, leaves)
        saved = saved + np.where(inside, (members - 1) * turn_size, 0)
        waiting = {"depth": [depth] * len(new),
                   "key": [keys[0 if f else 1][depth] if e else None for f, e in zip(starts, edge)],
                   "conv_id": least.tolist(), "n_convs": members.tolist(), "n_children": children.tolist(),
                   "n_leaves": leaves.tolist(), "saved_tokens": saved.tolist(), "last": turn_size.tolist(),
                   "ends_sha256": [digest[e] if e >= 0 else None for e in ender]}
        first, border = top, edge
        live = {"n_convs": members, "conv_id": least, "n_leaves": leaves, "saved_tokens": saved, "n_children": children}
    waiting["parent_conv_id"], waiting["parent_key"] = [None], [None]
    yield waiting


def _peeled(sorted_classes: DataFrame) -> DataFrame:
    def unit(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        turns = rows.column("turns")
        fields = turns.flatten()
        length = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        tokens = np.stack([fields.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b")], 1)
        size = fields.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
        columns = [rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("conv_id", "n")]
        for made in peel(tokens, size, np.cumsum(length), *columns, rows.column("ends").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in NODES], schema=NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        turns = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            turns += len(batch.column("turns").flatten()) + batch.num_rows
            if turns >= UNIT:
                yield from unit(held)
                held, turns = [], 0
        if held:
            yield from unit(held)

    return sorted_classes.mapInArrow(run, DDL)


def _edges(partial: DataFrame) -> DataFrame:
    """The whole nodes of the units' first and last rows, from their shares: one more
    peeling, of two paths a unit. Shares of one node are added up before."""
    whole = partial.groupBy("depth", "key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS],
        F.max("last").alias("last"), F.max("ends_sha256").alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below: dict[bytes, list[int]] = {}  # by the parent's key: children, leaves, saved tokens
        here: dict[bytes, list[int]] = {}
        depth = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["depth"] != depth:
                    depth, below, here = r["depth"], here, {}
                children, leaves, saved = below.pop(r["key"], (0, 0, 0))
                r["n_children"] += children
                r["n_leaves"] = r["n_leaves"] + leaves if r["n_children"] else 1
                r["saved_tokens"] += saved + (r["n_convs"] - 1) * r["last"]
                if r["parent_key"] is not None:
                    up = here.setdefault(r["parent_key"], [0, 0, 0])
                    for k, v in enumerate((1, r["n_leaves"], r["saved_tokens"])):
                        up[k] += v
                out.append(r)
            yield pa.RecordBatch.from_pylist(out, schema=NODES)

    order = whole.select(*[F.lit(None).cast("long").alias(c) if c == "parent_conv_id" else F.col(c) for c in NODES.names])
    return order.repartition(1).sortWithinPartitions(F.desc("depth")).mapInArrow(run, DDL)


def trie(convs: DataFrame) -> DataFrame:
    """The nodes of ``convs`` (conv_id, turns as of ``conversations``): conv_id (the smallest
    member), depth, parent_conv_id (the parent's conv_id), n_convs (members), n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (over the subtree, each node's
    members but one times the code points of its last text), ends_sha256 (of the ascending
    ids of the members that end here, joined by commas). conv_id and depth name the node: it is the first turns
    of that conversation."""
    spark = convs.sparkSession
    convs = landed(convs.select("conv_id", "turns", F.xxhash64("turns").alias("k1"), F.xxhash64(F.lit(1), "turns").alias("k2")), "conversations")
    classes = _classes(convs.select("conv_id", "k1", "k2")).select("conv_id", "n", "ends")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (classes.join(convs.select("conv_id", "turns"), "conv_id").select("turns", "conv_id", "n", "ends")
              .repartitionByRange(parts, "turns").sortWithinPartitions("turns"))
    nodes = landed(_peeled(ranged), "trie-nodes")
    edges = landed(_edges(nodes.where("key is not null")), "trie-edges")
    known = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    inner = nodes.where("key is null")
    out = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    return (inner.where("parent_key is null").select(*out)
            .union(join_spread(inner.where("parent_key is not null"), known, "parent_key")
                   .withColumn("parent_conv_id", F.col("_parent")).select(*out))
            .union(edges.join(known, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent")).select(*out))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % 100."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    base = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("given"))
    own = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    given = F.coalesce("given", F.array().cast(convs.schema["turns"].dataType))
    return own.join(base, "base", "left").select("conv_id", F.concat(
        F.slice(given, F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the prefix trie of the rebuilt conversations."""
    return trie(rebuilt(landed(conversations(table(spark, sf_dir, "conversations")), "turns")))


SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, ({crc32_sql("conv_id::VARCHAR")} % 6)::BIGINT AS h FROM t),
r AS (SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY o, i) AS d, role, text FROM (
        SELECT c.conv_id, 0 AS o, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
        UNION ALL SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h) c),
p AS (SELECT conv_id, 0::BIGINT AS d, '' AS k, 0::BIGINT AS n FROM c
      UNION ALL SELECT conv_id, d, string_agg(md5(length(role) || ':' || role || text), '')
                OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING), length(text) FROM r),
l AS (SELECT conv_id, max(d) AS len FROM p GROUP BY 1),
x AS (SELECT p.conv_id, d, md5(k) AS k, n, lag(md5(k)) OVER (PARTITION BY p.conv_id ORDER BY d) AS pk, d = len AS ends FROM p JOIN l USING (conv_id)),
node AS (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM x GROUP BY 1, 2),
ch AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
under AS (SELECT DISTINCT a.d, a.k, b.d AS bd, b.k AS bk FROM x a JOIN x b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (SELECT u.d, u.k, count(*) FILTER (ch.k IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.n)::BIGINT AS saved_tokens
         FROM under u JOIN node b ON b.d = u.bd AND b.k = u.bk LEFT JOIN ch ON ch.d = b.d AND ch.k = b.k GROUP BY 1, 2)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(ch.n_children, 0) AS n_children,
       sums.n_leaves, sums.saved_tokens, node.ends_sha256
FROM node JOIN sums USING (d, k) LEFT JOIN ch USING (d, k) LEFT JOIN node up ON up.d = node.d - 1 AND up.k = node.pk
"""
