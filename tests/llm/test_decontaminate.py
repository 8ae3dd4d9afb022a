import random

import pytest

from shelfprice.llm import decontaminate as D


def nearest(unit, text):
    """Smallest edit distance of ``unit`` to a part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(unit, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def words(rnd, n, alphabet="abcdefghijklmnop"):
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randrange(2, 8))) for _ in range(n))


def edited(s, k, rnd):
    s = list(s)
    for _ in range(k):
        at, kind = rnd.randrange(len(s)), rnd.randrange(3)
        if kind == 0:
            s[at] = rnd.choice("xyz")
        elif kind == 1:
            del s[at]
        else:
            s.insert(at, rnd.choice("xyz"))
    return "".join(s)


def cases():
    rnd = random.Random(4)
    items = [(i, words(rnd, n)) for i, n in enumerate([30, 60, 20, 9, 4, 3, 1, 45])] + [(20, "tiny"), (21, "a a a a a a a a a a a a a a a a")]
    texts = [None, "", "clean " + words(rnd, 100)]
    for i, t in items:
        for k in (0, 1, 3, 6, 9):
            texts.append(words(rnd, 15) + " \n " + edited(t, k if len(t) > 15 else 0, rnd).upper() + "\t " + words(rnd, 15))
    texts += [items[0][1], items[1][1][:119], "a " * 300, items[2][1] + words(rnd, 3) + items[2][1]]
    return items, texts


def want(items, texts):
    out = []
    for t in texts:
        s, found = D.normal(t or ""), set()
        for i, x in items:
            x = D.normal(x)
            if len(x) < D.Q:
                continue
            starts = list(range(0, max(1, len(x) - D.UNIT + 1), D.STRIDE))
            if starts[-1] + D.UNIT < len(x):
                starts.append(len(x) - D.UNIT)
            if any(nearest(x[a:a + D.UNIT], s) <= D.budget(len(x[a:a + D.UNIT])) for a in starts):
                found.add(i)
        out.append(found)
    return out


def test_against_brute_force():
    items, texts = cases()
    index = D.Index.of(items)
    got = index.hits(texts)
    assert [{h[0] for h in hits} for hits in got] == want(items, texts)
    for t, hits in zip(texts, got):
        for i, a, b, e in hits:
            part = D.normal(f"x{t[a:b]}x")[1:-1]  # blanks at the edges count
            x = D.normal(dict(items)[i])
            starts = {*range(0, max(1, len(x) - D.UNIT + 1), D.STRIDE), max(0, len(x) - D.UNIT)}
            assert min(nearest(x[s:s + D.UNIT], part) for s in starts) <= e


@pytest.mark.parametrize("piece,pairs", [(150, 1 << 22), (1 << 20, 300)])
def test_pieces_change_nothing(monkeypatch, piece, pairs):
    items, texts = cases()
    index = D.Index.of(items)
    whole = [{h[0] for h in x} for x in index.hits(texts)]
    monkeypatch.setattr(D, "PIECE", piece)
    monkeypatch.setattr(D, "PAIRS", pairs)
    assert [{h[0] for h in x} for x in index.hits(texts)] == whole


def test_rows(spark):
    items, texts = cases()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[3], "x", 1), (3, texts[3], "x", 1)],
                                 "doc_id long, text string, item_id string, hits int")
    bench = spark.createDataFrame(items + [(None, items[0][1]), (99, None), (7, items[7][1])], "item_id long, text string")
    for size in (1 << 20, 200):
        got = D.find_passages(docs, bench, block_bytes=size).collect()
        assert len(got) == len(texts) + 2
        ids = [{h.item_id for h in r.hits} for r in got[:len(texts)]]
        full = want(items, texts)
        assert [x - {None} for x in ids] == full
        assert all((None in x) == (0 in f) for x, f in zip(ids, full))
    assert D.find_passages(docs.limit(0), bench).count() == 0
    assert {len(r.hits) for r in D.find_passages(docs, bench.limit(0)).collect()} == {0}
