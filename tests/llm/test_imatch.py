import math
import random
import re
from hashlib import md5, sha256

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfprice.llm import imatch as I

SCHEMA = "doc_id long, text string, code string, _b int"


def words(text):
    t = (text or "").translate(str.maketrans(I.UPPER, I.LOWER))
    return sorted(set(re.split(I.BREAK, t)) - {""})


def code(term):
    d = md5(term.encode()).hexdigest()
    out = int(d[:10], 16) << 24
    for s in range(I.SEEDS):
        v = int(d[10 + 3 * s:13 + 3 * s], 16)
        out |= min(12 - max(1, v.bit_length()), I.LEVELS) << 4 * s
    return out - (1 << 64) if out >= 1 << 63 else out


def brute(texts, rare=I.RARE, common=I.COMMON):
    count = {}
    for t in texts:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    known = {w for w, n in count.items() if n * rare >= len(texts) and n * common <= len(texts)}

    def of(text):
        codes = sorted(code(w) for w in words(text) if w in known)
        if not codes:
            return [md5(" ".join(words(text)).encode()).hexdigest()[:16]] + [""] * (I.SEEDS * I.LEVELS)
        out = [codes]
        for level in range(1, I.LEVELS + 1):
            out += [[c for c in codes if c >> 4 * s & 15 >= level] for s in range(I.SEEDS)]
        return [md5(" ".join(map(str, c)).encode()).hexdigest()[:16] if c else "" for c in out]
    return of


def near(a, b):
    agree = sum(x == y != "" for x, y in zip(a, b))
    return 1.0 if a[0] == b[0] else round(1 - 2 ** (-agree / I.SEEDS), 9)


def docs():
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdeü") for _ in range(rnd.randrange(1, 6))) for _ in range(400)]
    out = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 80)))) for i in range(120)]
    out += [(200 + i, "a hot text, copied Often. the") for i in range(60)]
    out += [(300, None), (301, ""), (302, " .,-"), (None, "null id"), (None, "another"), (400, "solitary"), (401, "Solitary!")]
    return out + [(500, " ".join(rnd.choice(vocabulary) for _ in range(60_000))), (501, "same row"), (501, "same row")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*d, "x", 1) for d in docs()], SCHEMA).repartition(4)


def test_fingerprints_against_brute_force(table):
    of = brute([t for _, t in docs()])
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.fingerprint) for r in I.fingerprints(table).collect())
    assert got == sorted((i is not None, i or 0, ".".join(of(t))) for i, t in docs())


def test_lexicon_is_the_band(table):
    texts = [t for _, t in docs()]
    got = {r.term: (r.n, r.code) for r in I.lexicon(table, rare=50, common=4).collect()}
    count = {}
    for t in texts:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    assert got == {w: (n, code(w)) for w, n in count.items() if n * 50 >= len(texts) and n * 4 <= len(texts)}


def test_without_a_broadcast(spark, table, monkeypatch):
    want = sorted(r.fingerprint for r in I.fingerprints(table).collect())
    monkeypatch.setattr(I, "MOST", 0)
    assert sorted(r.fingerprint for r in I.fingerprints(table).collect()) == want


def test_likeness_follows_the_share_of_terms(spark):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = rnd.sample(vocabulary, 200)
    texts = [" ".join(base)]
    for changed in (1, 20, 100, 200):
        texts.append(" ".join(base[changed:] + rnd.sample(vocabulary, changed)))
    of = brute(texts * 10, rare=100, common=1)
    found = [near(of(texts[0]), of(t)) for t in texts]
    assert found[0] == 1 and found == sorted(found, reverse=True) and found[1] > 0.9 and 0.1 < found[3] < 0.7 and found[4] < 0.2


@pytest.mark.parametrize("buckets", [1, 5, 64])
def test_with_next(spark, table, buckets):
    rows = table.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates()
    order = Window.partitionBy("_b").orderBy("_guard", "doc_id", "_h")
    got = (I.with_next(rows, "doc_id", "text", buckets).withColumn("next", F.lead("doc_id").over(order))
           .withColumn("next_text", F.lead("text").over(order)).where("not _guard").collect())
    ordered = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r._h))
    assert len(ordered) == rows.count()
    for k, r in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)]
        assert (r.next, r.next_text) == (after.doc_id, after.text)


def run_query(spark, tmp_path, rows):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return I.query(spark, str(tmp_path)).collect()


def test_query_against_brute_force(spark, tmp_path):
    rows = [d for d in docs() if d[0] is not None][:-1]
    of, got = brute([t for _, t in rows]), {r.doc_id: r for r in run_query(spark, tmp_path, rows)}
    assert len(got) == len(rows)
    rows = sorted((i, t or "") for i, t in rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        r, half = got[i], len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (".".join(of(t)), ".".join(of(edited)))
        assert math.isclose(r.near_edited, near(of(t), of(edited))) and math.isclose(r.near_next, near(of(t), of(after)))


def test_query_on_edge_tables(spark, tmp_path):
    assert run_query(spark, tmp_path / "none", []) == []
    one = run_query(spark, tmp_path / "one", [(1, "abcd")])
    assert [(r.edited_sha256, r.near_next) for r in one] == [(sha256(b"abab").hexdigest(), 1.0)]
    odd = run_query(spark, tmp_path / "odd", [(None, None), (None, None), (None, "x"), (3, "same"), (3, "same")])
    assert len(odd) == 5 and len({r.fingerprint for r in odd}) == 3


def test_duplicate_classes(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = [" ".join(rnd.sample(vocabulary, 60)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[3]) for i in range(30)]
    rows += [(200, texts[5] + " common"), (201, "common " * 3)] + [(300 + i, "common") for i in range(5)] + [(None, texts[3])]
    got = dict(I.duplicate_classes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect())
    assert all(got[100 + i] == 3 for i in range(30)) and set(got) == {i for i, _ in rows} - {None}
    assert got[200] == 5 and {got[300 + i] for i in range(5)} == {201} == {got[201]}
    assert all(got[i] == i for i in range(20))
