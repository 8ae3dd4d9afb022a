import random
from itertools import combinations
from math import sqrt

import numpy as np
import pytest

from pyspark.sql import functions as F
from shelfprice.llm import toxicity as X

BAD = ["nasty", "villain", "rotten"]


def slow_kernel(a, b):
    def feature(w):
        w, out = "^" + w, {}
        for i, j, k in combinations(range(len(w)), 3):
            key = w[i] + w[j] + w[k]
            out[key] = out.get(key, 0) + X.DECAY ** (k - i + 1)
        return out
    fa, fb = feature(a), feature(b)
    dot = lambda x, y: sum(v * y.get(u, 0) for u, v in x.items())
    return dot(fa, fb) / sqrt(dot(fa, fa) * dot(fb, fb))


def corpus(seed=0, docs=600):
    rnd = random.Random(seed)
    syllables = "ba co di fu ga he li mo nu pa re si to vu".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 5)))
    rows = []
    for i in range(docs):
        w = [word() for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                w[rnd.randrange(60)] = rnd.choice(BAD)
        rows.append((i, " ".join(w) + ".", int(i % 4 == 0)))
    return rows


def test_kernel():
    words = ["stupid", "stuxpid", "banana", "abc", "aaa", "strength"]
    want = [[slow_kernel(a, b) for b in words] for a in words]
    assert np.allclose(X.kernel(words, words), want)


def test_folding():
    assert X.fold("st-u.pid!") == "stupid" and X.fold("m0r0n") == "moron"
    assert {"stupid", "ok"} - X.words_of("so s t u p i d ok") == {"ok"}
    assert X.words_of("") == set() and all(len(w) <= X.WIDE for w in X.words_of("x" * 50_000))


@pytest.fixture(scope="module")
def model():
    rows = corpus()
    return X.fit([t for _, t, _ in rows], [y for _, _, y in rows])


def test_held_out_accuracy(model):
    rows = corpus(seed=5)
    bags = [X.words_of(t) for _, t, _ in rows]
    words = list(set().union(*bags))
    p = model.score(model.highest(bags, dict(zip(words, model.decide(words))))) >= 0.5
    y = np.array([y for _, _, y in rows], bool)
    assert (p & y).sum() >= 0.95 * y.sum() and (p & ~y).sum() <= 0.01 * (~y).sum()


def test_gapped_words_are_tolerated(model):
    bad = model.decide(["nasty", "naxsty", "vilzlain", X.fold("r-o-t-t-e-n"), X.fold("v*illain")])
    assert (bad > 0).all() and (model.decide(["banana", "copavu", "silimo", "nu"]) < 0).all()


def test_fit_without_both_classes():
    assert X.fit(["a b c"], [0]) is None and X.fit([], []) is None


def test_query_rows(spark):
    rows = corpus(docs=800)
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t, _ in rows] + [
        (900, None, "s", 1), (901, "", "s", 1), (None, "nasty villain rotten", "s", 1), (1, rows[1][1], "s", 1),
        (902, ("pa re " * 9000) + "nasty villain rotten", "s", 1)], "doc_id long, text string, source string, score int")
    labels = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(0, 0, 0), (900, 0, None), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = X.train(docs, labels, sample=300)
    got = X.score(docs, model).withColumn("h", X.held_out()).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score < 0.5 and by[None].predicted == 1 == by[902].predicted
    import zlib
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    held = [r for r in got if r.h and r.doc_id is not None and r.doc_id < 800]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.97
    assert X.train(docs.limit(0), labels.limit(0)) is None
    assert {r.score for r in X.score(docs, None).collect()} == {0.0}
    assert X.score(docs.limit(0), model).count() == 0 and F is not None
