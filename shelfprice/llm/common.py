"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read with Spark's Parquet reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.
    Only where the session names none (tests on one machine) a new local one is
    set."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="shelfprice-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: the lineage ends there, so a lost
    executor costs a read and not a second run of the producer."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: lineage is
    cut, and later readers get column pruning."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_spread(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join on ``key`` where ``right`` is an aggregate by ``key`` and ``left`` may hold
    most of its rows under one key. The added join column follows from ``key``, but
    neither side is partitioned by both, so both are exchanged for the join itself
    and adaptive execution can split a hot key of ``left`` over many tasks."""
    c, keys = "_spread", [key] if isinstance(key, str) else list(key)
    return (left.withColumn(c, F.xxhash64(*keys))
            .join(right.withColumn(c, F.xxhash64(*keys)), [*keys, c], how).drop(c))


def crc32_sql(s: str) -> str:
    """CRC-32 of an ASCII string in SQL: a byte is folded in, then eight bits are shifted out."""
    bits = f"list_transform(range(1, length({s}) + 1), lambda i: [ascii(substr({s}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], flatten({bits})), lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) "
            "ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295::BIGINT)")
