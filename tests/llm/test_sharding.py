from collections import Counter

import pytest
import xxhash

from shelfprice.llm import sharding
from shelfprice.llm.common import scratch


def slow_table(weights, size):
    names = sorted(weights)
    orders = [[(sharding._hash(n, 0) + j * (sharding._hash(n, 1) % (size - 1) + 1)) % size for j in range(size)] for n in names]
    slots, left = {}, size
    while left:
        for i, n in enumerate(names):
            for _ in range(weights[n]):
                if left:
                    slots[next(s for s in orders[i] if s not in slots)] = i
                    left -= 1
    return [slots[s] for s in range(size)]


@pytest.mark.parametrize("weights,size", [({"a": 1}, 7), ({"a": 1, "b": 1, "c": 1}, 101), ({"a": 3, "b": 1}, 211)])
def test_table_against_brute_force(weights, size):
    names, slots = sharding.lookup_table(weights, size)
    assert names == sorted(weights) and slots.tolist() == slow_table(weights, size)


def test_balance_and_little_movement():
    names = [f"s{i}" for i in range(50)]
    _, a = sharding.lookup_table(names)
    share = Counter(a.tolist())
    assert max(share.values()) - min(share.values()) <= 1
    kept, b = sharding.lookup_table(names[:-1])
    full = sorted(names)
    moved = sum(full[x] != kept[y] for x, y in zip(a.tolist(), b.tolist()) if full[x] != "s49")
    assert moved < 0.1 * len(a)


def test_bad_parameters():
    for bad in ((["a"], 10), ([], 7), (["a", "b", "c"], 2), ({"a": 0}, 7), (["a"], 8388617)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_place(spark):
    rows = [(1, "x", "c"), (None, "y", "c"), (None, "z", "c"), (1, "x", "c"), (-5, None, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    got = sharding.place(df, ["doc_id"], ["a", "b", "c"], 101).collect()
    names, slots = sharding.lookup_table(["a", "b", "c"], 101)
    assert len(got) == 5
    for r in got:
        h = 42 if r.doc_id is None else xxhash.xxh64_intdigest(r.doc_id.to_bytes(8, "little", signed=True), 42)
        h = h - (1 << 64) if h >> 63 else h
        assert r.slot == h % 101 and r.shard == names[slots[r.slot]]
    assert sharding.place(df.limit(0), ["doc_id"], ["a"], 7).count() == 0


def test_write(spark):
    path = scratch(spark, "shards")
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    sharding.write_shards(df, path, ["doc_id"], ["a", "b"], 101)
    back = spark.read.parquet(path)
    assert back.select("doc_id").distinct().count() == 500
    want = {r.doc_id: r.shard for r in sharding.place(df, ["doc_id"], ["a", "b"], 101).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want
