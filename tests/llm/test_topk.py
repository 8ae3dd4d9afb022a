import math

import numpy as np
import pytest

from shelfprice.llm import topk


def brute(rows, ask, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in ok if ask(i)}:
        s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))
        out |= {(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)}
    return out


@pytest.mark.parametrize("seed,n,dims,spread", [(0, 900, 16, 1.0), (1, 700, 64, 0.12), (2, 400, 3, 0.01), (3, 300, 8, 40.0)])
def test_block_against_brute_force(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    v = np.floor(256 * rng.normal(0, spread, (n, dims))).astype(np.int64)
    v[n // 2: n // 2 + 60] = v[5]  # a large group of equal vectors
    ids = rng.permutation(n) * 3
    block = topk.Block(ids, v)
    for r in range(0, n, 23):
        scores = sorted((-int(a @ v[r]), int(i)) for a, i in zip(v, ids) if i != ids[r])
        assert block.search(v[r], int(ids[r]), 5) == [(-s, i) for s, i in scores[:5]]


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 12)]) for i in range(-150, 250)]
    rows += [(500, None), (501, [None] * 12), (550, [float("nan")] * 12), (None, rows[3][1]), (600, [1.0, -1.0]),
             (601, [0.5, 0.5]), (650, []), (651, []), (700, rows[7][1]), (701, rows[7][1]), (702, rows[7][1]),
             (750, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df.repartition(3), df.where("vec_id % 50 = 0"), 5).collect()
    assert {tuple(r) for r in got} == brute(f32, lambda i: i % 50 == 0, 5)
    assert len(got) == len({tuple(r) for r in got})
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
