"""Exact top-k inner products from an impact-ordered, score-at-a-time index.

Each component x becomes the integer floor(256 * x). The index is made of blocks of
vectors, built where the rows lie. A block holds, for every dimension, its vectors in
the order of their value (the postings), cut into segments of one quantised value
(``WIDTH`` wide). A segment's impact for a query is the query's component times the
segment's best value, an upper bound for each of its postings.

A query works on a block by falling impact: it processes the segments of all dimensions
whose impact is above a level. A vector's score is then at most the sum of the impacts of
its processed postings and, for each other dimension, of the highest impact not yet
processed there. The vectors with the best bounds are scored exactly, which gives a floor
under the k-th best score; all vectors whose bound is under the floor are proven out. If
few are left, they are rescored exactly and the search stops; else it goes down to the
next level. There are two (``LEVELS``): all segments of an impact over -0.05 times the
highest, in the order of dimensions, then the rest. So falling impact decides one early stop
only. The last level leaves no segment out, so the search always ends with a proof.
Nothing is approximate, no list is cut.

Blocks of queries meet blocks of the index by an equal join on both block numbers; the
k best per query and block go on to one ranked window per query.

Defined results: vectors that are null, or hold a null or non-finite component, and rows
without an id take no part. Vectors of another length than the query's are no
candidates. Rows with the query's id are never candidates; a query row that repeats as a
whole is one query, and rows of one id and different vectors rank separately. Ties go to
the smaller id, candidate rows that repeat are all candidates. Other columns are ignored.
An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import landed, table

WIDTH = 4
BLOCK = 8192          # vectors of a block
QUERY_BLOCK = 2048    # queries of a block
LEVELS = (-0.05, -np.inf)  # of a query's highest impact
FAR = 1 << 50
FEW = 96              # this many vectors are rescored at any rate


class Block:
    """The index of some vectors of one length, rows in the order of their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        (n, dims), level = self.vectors.shape, self.vectors // WIDTH
        postings = np.argsort(-level, axis=0, kind="stable").T
        levels = np.take_along_axis(level, postings.T, axis=0).T  # falling, by dimension
        begins = [np.flatnonzero(np.append(True, x[1:] != x[:-1])) for x in levels] if n else []
        most = max(map(len, begins), default=0)
        # for weights of either sign: postings by falling impact, and by segment its
        # quantised value, size and the postings before it
        self.sides = []
        for sign in (1, -1):
            value, size = np.zeros((dims, most), np.int64), np.zeros((dims, most), np.int64)
            for d, at in enumerate(begins):
                value[d, :len(at)] = levels[d][at][::sign]
                size[d, :len(at)] = np.diff(at, append=n)[::sign]
            self.sides.append((np.ascontiguousarray(postings[:, ::sign]), value, size,
                               np.hstack([np.zeros((dims, 1), np.int64), size.cumsum(1)])))
        self.counts = np.array([len(x) for x in begins], np.int64)

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) of the block, best first."""
        n, dims = self.vectors.shape
        others = self.ids != own
        if n <= FEW or not dims:
            return self.exact(np.flatnonzero(others), query, k)
        (up, value, size, before), (down, value2, size2, before2) = self.sides
        rising = query[:, None] >= 0
        impact = query[:, None] * np.where(rising, value * WIDTH + WIDTH - 1, value2 * WIDTH)
        impact[np.arange(impact.shape[1]) >= self.counts[:, None]] = -FAR
        size, before = np.where(rising, size, size2), np.where(rising, before, before2)
        dim, top = np.arange(dims), max(1, int(impact[:, 0].max()))
        floor, alive = -FAR * dims, np.flatnonzero(others)
        for level in LEVELS:
            # by dimension: segments above the level, their postings, the best one left
            upto = self.counts if np.isinf(level) else (impact > level * top).sum(1)
            ends, rest = before[dim, upto], impact[dim, np.minimum(upto, self.counts - 1)]
            bound = np.full(n, rest.sum())
            for d in np.flatnonzero(ends):
                posted = (up if rising[d, 0] else down)[d]
                bound[posted[:ends[d]]] += np.repeat(impact[d, :upto[d]] - rest[d], size[d, :upto[d]])
            best = np.argpartition(np.where(others, bound, -FAR * dims), n - FEW)[n - FEW:]
            scores = np.sort(self.vectors[best[others[best]]] @ query)
            if len(scores) >= k:
                floor = max(floor, int(scores[-k]))
                alive = np.flatnonzero((bound >= floor) & others)
            if len(alive) <= max(FEW, n // 16):
                break
        return self.exact(alive, query, k)

    def exact(self, rows: np.ndarray, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return [(int(scores[b]), int(self.ids[rows[b]])) for b in best]


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def _blocks(df: DataFrame, size: int, name: str) -> DataFrame:
    """(part, number, dims, ids, values): rows of up to ``size`` vectors of one length,
    as raw integers, made where the rows lie."""
    schema = "part int, number int, dims int, ids binary, values binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, held = TaskContext.get().partitionId(), 0, {}

        def row(dims: int, whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            ids = np.concatenate([x[0] for x in held[dims]])
            values = np.concatenate([x[1] for x in held[dims]])
            while len(ids) >= size or whole and len(ids):
                yield pa.RecordBatch.from_pylist([{
                    "part": part, "number": number, "dims": dims, "ids": ids[:size].tobytes(),
                    "values": values[:size].tobytes()}], schema=kinds)
                number += 1
                ids, values = ids[size:], values[size:]
            held[dims] = [(ids, values)]

        kinds = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("dims", pa.int32()),
                           ("ids", pa.binary()), ("values", pa.binary())])
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("v")
            lengths = np.array(lists.value_lengths(), np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                values = flat[starts[at][:, None] + np.arange(dims)].reshape(len(at), dims)
                held.setdefault(int(dims), []).append((ids[at], values))
                if sum(len(x[0]) for x in held[int(dims)]) >= size:
                    yield from row(int(dims), False)
        for dims in list(held):
            yield from row(dims, True)

    return landed(df.mapInArrow(run, schema), name)


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k best rows of
    ``df`` by integer inner product. Both have ``id_col`` and ``vector``."""
    spark = df.sparkSession

    def prepared(x: DataFrame) -> DataFrame:
        return (x.where(F.col(id_col).isNotNull() & usable(F.col(vector)))
                .select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector)).alias("v")))
    index = _blocks(prepared(df), BLOCK, "impact-index")
    asked = _blocks(prepared(queries).distinct(), QUERY_BLOCK, "impact-queries")
    # one row per pair of blocks; the block lists are short tables of numbers
    left = index.select("part", "number", "dims")
    right = asked.select(F.col("part").alias("qpart"), F.col("number").alias("qnumber"), "dims")
    pairs = left.join(right, "dims")
    work = (pairs.join(asked.select(F.col("part").alias("qpart"), F.col("number").alias("qnumber"),
                                    F.col("ids").alias("qids"), F.col("values").alias("qvalues")),
                       ["qpart", "qnumber"])
            .join(index.drop("dims"), ["part", "number"])
            .repartition(F.col("part"), F.col("number"), F.col("qpart"), F.col("qnumber")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                def matrix(ids: str, values: str) -> tuple[np.ndarray, np.ndarray]:
                    i = np.frombuffer(row[ids], np.int64)
                    return i, np.frombuffer(row[values], np.int64).reshape(len(i), row["dims"])
                qids, qs = matrix("qids", "qvalues")
                ids, vs = matrix("ids", "values")
                if row["dims"] and float(np.abs(qs).max()) * float(np.abs(vs).max()) * row["dims"] ** 2 >= 2.0 ** 48:
                    raise OverflowError("components too large for 64-bit scores")
                block = Block(ids, vs)
                out = [(int(i), q.tobytes(), s, c) for i, q in zip(qids, qs) for s, c in block.search(q, int(i), k)]
                if out:
                    a, b, s, c = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.int64()), pa.array(b, pa.binary()), pa.array(s, pa.int64()),
                         pa.array(c, pa.int64())], names=["query_id", "q", "score", "vec_id"])

    found = work.select("dims", "qids", "qvalues", "ids", "values") \
        .mapInArrow(run, "query_id long, q binary, score long, vec_id long")
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the 5 best partners of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5
"""
