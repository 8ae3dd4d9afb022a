import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfprice.llm import merkle as M

SCHEMA = "id long, g string, text string, top string, b int"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(ds):
    out = [ds]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(lv, i):
    out = []
    for run in lv[:-1]:
        a = i // 3 * 3
        out.append((run[a:i], run[i + 1:a + 3]))
        i //= 3
    return out


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    groups = {}
    for i, g, text in rows:
        other = h([field(i), field(text.replace("\n", ""))]) if text and "\n" in text else None
        groups.setdefault(g, []).append((i, h([field(i), field(text)]), other))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for n, (i, leaf, other) in enumerate(groups[g]):
            path, folded = siblings(trees[g], n) + siblings(top, k), other or leaf
            for a, b in path:
                folded = h([*a, folded, *b])
            out.append((g, i, leaf, trees[g][-1][0], h([x for a, b in path for x in a + b]), folded, top[-1][0]))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(7)
    out = [(i, "hot", rnd.choice(["a\nb", "ü", "", None])) for i in range(300)]
    out += [(i, f"s{i % 23}", f"t{i}\n") for i in range(300, 420)]
    out += [(500 + i, f"own{i}", "x") for i in range(12)] + [(600, None, "n"), (601, None, "m"), (602, "", "e"), (603, "é", "e")]
    out += [(None, "hot", "null id\n"), (None, "hot", "b")] + [(5, "hot", "same")] * 3 + [(None, None, None)] * 2
    return out + [(700, "long", "z\n" * 100_000)]


def leaves(df):
    first = M.digest_of(F.col("id"), F.col("text"))
    return df.select("g", "id", first.alias("d"), F.when(F.col("text").contains("\n"), M.digest_of(
        F.col("id"), F.replace("text", F.lit("\n"), F.lit("")))).alias("other"), "top", "b")


@pytest.mark.parametrize("depth, parts", [(1, 5), (2, 3), (7, 8)])
def test_against_brute_force(spark, monkeypatch, depth, parts):
    monkeypatch.setattr(M, "LEVELS", depth)
    monkeypatch.setattr(M, "BLOCK", 3 ** depth)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(*r[:1], r[1], r[2], "x", 1) for r in rows()], SCHEMA).repartition(4)
        got = M.manifest(leaves(df)).select("g", "id", "d", "subroot", "proof_sha256", "folded_root", "root").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(map(tuple, got), key=str) == brute(rows())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_sweeps_of_one_block(n):
    ds = [h([str(i)]) for i in range(n)]
    lv = M.forward(ds)
    assert lv == levels(ds)
    proofs = list(M.backward(lv, ""))
    assert len(proofs) == n
    for i, proof in enumerate(proofs):
        assert M.fold(ds[i], proof) == lv[-1][0]
        assert M.siblings_digest(proof) == h([x for a, b in siblings(lv, i) for x in a + b])
        assert n == 1 or M.fold("0" * 64, proof) != lv[-1][0]


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(1, "s", "t", "x", 1)], SCHEMA)
    r = M.manifest(leaves(one)).first()
    assert r.d == r.subroot == r.root == r.folded_root and r.proof_sha256 == h([])
    assert M.manifest(leaves(one.limit(0))).collect() == []


def test_digest_of(spark):
    r = spark.range(1).select(M.digest_of(F.lit(12), F.lit(None).cast("string"), F.lit("ü")).alias("d")).first()
    assert r.d == sha256("2:12-2:ü".encode()).hexdigest()
