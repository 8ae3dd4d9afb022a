import random
import zlib
from hashlib import sha256

import pytest

from shelfprice.llm import prefixtrie as P

SCHEMA = "conv_id long, turn int, role string, text string, turns string, depth int"


def rows():
    rnd = random.Random(4)
    out = []
    for c in [*range(0, 60), *range(100, 130), 1_000_000, 70_000, 140_001]:
        for t in range(rnd.randrange(0, 7)):
            out.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "bb", "ü€", None])))
    out += [(200 + c, t, "user", f"same {t}") for c in range(40) for t in range(4)]  # many copies
    out += [(70_200 + c, t, "user", f"same {t}") for c in range(3) for t in range(4)]  # copies in another pack
    out += [(300 + c, t, "user", f"long {t}" if t < 150 + c else f"own {c}") for c in range(4) for t in range(180)]
    out += [(400, None, None, "null turn"), (400, 1, "x", "one"), (400, 1, "x", "one"), (None, 0, "user", "no conversation")]
    out += [(801 + c, 0, "user", "z") for c in range(8)]  # their base has no row
    out += [(500, 0, "user", "y" * 200_000), (500, 1, "user", "")]
    return out


def turns_of(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def brute(convs):
    """Nodes by their turns, without any peeling."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, subtree = {}, {k: [] for k in members}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
        for d in range(len(k) + 1):
            subtree[k[:d]].append(k)
    out = set()
    for k, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(k))
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])),
                 sum(x not in children for x in subtree[k]),
                 sum((len(members[x]) - 1) * len(x[-1][1]) for x in subtree[k] if x),
                 sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def got(df):
    found = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA).repartition(5)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_against_brute_force(spark, table, parts, monkeypatch):
    if parts == 7:
        monkeypatch.setattr(P, "UNIT", 60)  # units end within partitions, too
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert got(P.trie(P.conversations(table))) == brute(turns_of(rows()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_rebuilt(spark, table):
    convs = turns_of(rows())
    want = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = convs.get(c - c % 100, [])[:h] + turns[h:]
    assert any(not t for t in want.values())  # some have no turn left
    assert got(P.trie(P.rebuilt(P.conversations(table)))) == brute(want)


def test_null_text_counts_as_empty(spark):
    some = spark.createDataFrame([(1, 0, None, None, "", 0), (2, 0, "", "", "", 0)], SCHEMA)
    assert got(P.trie(P.conversations(some))) == brute({1: [("", "")], 2: [("", "")]})


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert P.trie(P.conversations(none)).collect() == []
    assert P.trie(P.rebuilt(P.conversations(none))).collect() == []
    only_null = spark.createDataFrame([(None, 0, "user", "x", "", 0)], SCHEMA)
    assert P.trie(P.conversations(only_null)).collect() == []
