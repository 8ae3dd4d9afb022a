import random

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F
from shelfprice.llm import simhash
from shelfprice.llm.components import components


def slow(text, words=3):
    t = [w for w in (text or "").encode().lower().split()]
    if not t:
        return 0
    s = [b" ".join(t[i:i + words]) for i in range(len(t) - words + 1)] or [b" ".join(t)]
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    ids = sorted({f for _, f in rows})
    parent = {f: f for f in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return {f: least.get(find(f)) for f in ids}


def test_golay_is_perfect_and_pairs_share_a_key():
    g = simhash.Golay()
    words = np.arange(1 << 23)
    assert np.bincount(g.decode(words)).tolist() == [2048] * 4096
    rng = np.random.default_rng(1)
    for bits in (21, 22):
        a = rng.integers(0, 1 << bits, 3000)
        for flips in (0, 1, 2):
            b = a.copy()
            for k in range(flips):
                b ^= 1 << (rng.integers(0, bits, 3000))
            ka, kb = ({(int(r), int(c)) for r, c in zip(*g.keys(x, bits))} for x in (a, b))
            assert len({r for r, _ in ka & kb}) == 3000


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "one TWO", "a b c", "É x y Z  z\x0bq " * 9,
                                  "many different words " * 6000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) & (2 ** 64 - 1) == slow(text)


@pytest.mark.parametrize("bucket", [1, 32])
def test_links_give_the_brute_force_components(spark, bucket):
    rnd = random.Random(7)
    rows, i = [], 0
    for _ in range(25):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 12])):
            f = base
            for _ in range(rnd.choice([0, 1, 2, 3])):
                f ^= 1 << rnd.randrange(64)
            rows.append((i, f - (1 << 64) if f >> 63 else f))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    found = components(simhash.links(df.select("fp").distinct(), 2, bucket)).collect()
    root = {r.node: r.root for r in found}
    least = {}
    for d, f in rows:
        least[root.get(f, f)] = min(least.get(root.get(f, f), d), d)
    assert {f: least[root.get(f, f)] for _, f in rows} == brute(rows)


def test_rows(spark):
    rnd = random.Random(3)
    base = [rnd.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rnd.randrange(50)) for _ in range(400)]
    texts = [" ".join(base)] * 2
    for k in range(30):
        w = list(base)
        w[rnd.randrange(400)] = "new"
        texts.append(" ".join(w))
    texts += ["", None, "x", "other text here entirely", "A B c", "a b C"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[0], "n"), (None, "only null", "n"), (0, texts[0], "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute([(d, slow(t)) for d, t, _ in rows])
    for r in got:
        assert r.component_id == want[r.fp & (2 ** 64 - 1)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_keep_one_with_repeated_and_null_ids(spark):
    rnd = random.Random(4)

    def linked():
        base = [f"word{rnd.randrange(90)}" for _ in range(400)]
        while True:
            other = list(base)
            other[rnd.randrange(400)] = "new"
            if 1 <= (slow(" ".join(base)) ^ slow(" ".join(other))).bit_count() <= 2:
                return " ".join(base), " ".join(other)
    (a, a2), (b, b2), (c, c2) = linked(), linked(), linked()
    rows = [(1, a), (2, a2), (1, b), (3, b2), (None, c), (None, c2)]
    kept = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert (1, a) in kept and (1, b) in kept and len(kept) == 3
    assert [r for r in kept if r[0] is None][0][1] in (c, c2)
