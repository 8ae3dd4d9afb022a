import random

import numpy as np
import pytest

from shelfprice.llm import suffixdedup as S
from shelfprice.llm.suffixes import repeats


def brute(docs):
    """docs: bytes in their order -> (kept, removed runs) of each."""
    seen, out = set(), []
    for t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - S.LENGTH + 1):
            w = t[i:i + S.LENGTH]
            if w in seen:
                gone[i:i + S.LENGTH] = True
            seen.add(w)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        out.append((bytes(np.frombuffer(t, np.uint8)[~gone]), [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]))
    return out


@pytest.mark.parametrize("text", [b"", b"a", b"ab" * 200, b"a" * 500, b"x" * 50 + bytes(range(150)) * 4 + b"\0" * 300,
                                  bytes(np.random.default_rng(0).integers(0, 3, 900, dtype=np.uint8)) * 2])
def test_suffix_array_repeats(text):
    x = np.frombuffer(text, np.uint8)
    valid = np.arange(len(x)) + 100 <= len(x)
    valid[::7] = False
    seen, want = set(), []
    for i in range(len(text)):
        w = text[i:i + 100]
        want.append(bool(valid[i] and w in seen))
        if valid[i]:
            seen.add(w)
    assert repeats(x, valid, 100).tolist() == want


def corpus():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, copies = text(60), text(120)
    docs = []
    for i in range(120):
        t = text(rnd.randrange(5, 60))
        if i % 3 == 0:  # a passage within other text: its edges differ everywhere
            t += " " + passage[:rnd.choice([99, 100, 101, 200, len(passage)])] + " " + text(8)
        if i % 5 == 0:
            w = copies.split()
            w[rnd.randrange(len(w))] = word()
            t = " ".join(w) + (text(4) if i % 2 else "")
        docs.append(t)
    docs += [docs[7], docs[30], "é" * 260, "z" * 900, "z" * 99, "", "q" * 100, "\0" * 250, text(700)[:4000] * 2]
    return docs


@pytest.mark.parametrize("shard,many", [(3 << 20, 2048), (1500, 2048), (1500, 3)])
def test_against_brute_force(spark, monkeypatch, shard, many):
    monkeypatch.setattr(S, "SHARD", shard)
    monkeypatch.setattr(S, "MANY", many)
    docs = corpus()
    rows = [(i * 3 - 50, t, "x") for i, t in enumerate(docs)]
    random.Random(1).shuffle(rows)
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(6)).collect()
    want = brute([t.encode() for t in docs])
    assert len(got) == len(docs)
    for r in sorted(got, key=lambda r: r.id):
        kept, runs = want[(r.id + 50) // 3]
        assert (bytes(r.kept), [tuple(x) for x in r.removed]) == (kept, runs), r.id
        assert r.n_bytes == len(docs[(r.id + 50) // 3].encode())


def test_null_and_repeated_rows(spark):
    a, b = "alpha beta " * 1 + "gamma " * 30, "delta epsilon zeta eta " * 9
    rows = [(None, a), (None, a), (5, a), (5, a), (5, b), (6, None), (6, None), (7, "short"), (7, "short"), (7, "short")]
    got = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    whole = brute([a.encode()])[0][0]
    assert sorted(bytes(r.kept) for r in got if r.id is None) == sorted([b"", whole])
    assert sorted(bytes(r.kept) for r in got if r.id == 5) == sorted([b"", b"", brute([b.encode()])[0][0]])
    assert [bytes(r.kept) for r in got if r.id == 7] == [b"short"] * 3 and sum(r.n_bytes == 0 for r in got) == 2
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
