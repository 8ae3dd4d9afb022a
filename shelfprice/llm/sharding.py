"""Placement of rows on shards by a permutation-filled lookup table.

Every shard walks a permutation of the slots of a prime-sized table (offset and skip
from two hashes of its name). The shards take turns, in the order of their names, each
claiming the next slot of its permutation that is still free, until the table is full.
A shard of weight w takes w turns a round. So slots are shared out evenly, and when a
shard goes, nearly all slots of the others stay where they are.

The table is made on the driver: its size is a parameter (``MAX_SIZE`` at most), not a
function of the data. It is broadcast; a row's place is one hash and one lookup.

Defined results: a null key hashes like any other value, so rows with a null key share
one slot. Repeated rows go to the same shard. Input columns named ``slot`` or
``shard`` are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SIZE = 65537
MAX_SIZE = 1 << 22


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def _hash(name: str, seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: dict[str, int] | list[str], size: int = SIZE) -> tuple[list[str], np.ndarray]:
    """(sorted shard names, for each slot the index of its shard). ``shards`` may give
    each name a positive whole weight."""
    weights = dict(shards) if isinstance(shards, dict) else {s: 1 for s in shards}
    names = sorted(weights)
    if not names or len(names) > size or min(weights.values()) < 1:
        raise ValueError("one shard at least, no more shards than slots, weights of one or more")
    if size > MAX_SIZE or not _is_prime(size):
        raise ValueError(f"the table size must be a prime of up to {MAX_SIZE}")
    at = [_hash(n, 0) % size for n in names]
    skip = [_hash(n, 1) % (size - 1) + 1 if size > 2 else 1 for n in names]
    slots, free = [-1] * size, size
    turns = [i for i, n in enumerate(names) for _ in range(weights[n])]
    while free:
        for i in turns:
            while slots[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            slots[at[i]] = i
            free -= 1
            if not free:
                break
    return names, np.array(slots, np.int32)


def slot_of(*keys: Column, size: int = SIZE) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(size)).cast("int")


def place(df: DataFrame, keys: list[str], shards: dict[str, int] | list[str], size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``."""
    names, slots = lookup_table(shards, size)
    rows = df.select(*[c for c in df.columns if c not in ("slot", "shard")],
                     slot_of(*[F.col(k) for k in keys], size=size).alias("slot"))
    where = df.sparkSession.createDataFrame(
        [(s, names[i]) for s, i in enumerate(slots.tolist())], "slot int, shard string")
    return rows.join(F.broadcast(where), "slot").select(*rows.columns, "shard")


def write_shards(df: DataFrame, path: str, keys: list[str], shards: dict[str, int] | list[str],
                 size: int = SIZE, files: int = 8) -> None:
    """Write ``df`` as Parquet, one folder per shard, of up to ``files`` files each: rows
    are dealt by shard and a share of the row's hash, so no task takes a whole shard."""
    placed = place(df, keys, shards, size)
    (placed.repartition("shard", F.pmod(F.xxhash64(*df.columns), F.lit(files)))
     .write.partitionBy("shard").parquet(path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the shard of every document, for 48 shards, four of them of double weight."""
    shards = {f"shard-{i:03d}": 2 if i < 4 else 1 for i in range(48)}
    return place(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], shards)
