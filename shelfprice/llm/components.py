"""Connected components of an edge table by alternating large-star and small-star
rounds. Every step is a join or an aggregate on one node id: minima are aggregated
map-side, hot nodes are split by the join, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, join_spread


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return join_spread(both.where("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    near = join_spread(e, least, "a")
    return (near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), two ids of one type, in any order and with repeats.

    Returns (node, root) for every node that has an edge, ``root`` being the smallest
    node of its component. Each round is checkpointed in the shared folder. Null ids
    and loops are ignored; an empty table gives an empty one."""
    a, b = edges.columns[:2]
    e = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
            .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    sign = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")]
    before = e.agg(*sign).first()
    while before.n:
        e = cut(_small(_large(e).distinct()).distinct())
        now = e.agg(*sign).first()
        if now == before:
            break
        before = now
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")) \
        .union(roots.select("node", F.col("node").alias("root")))
