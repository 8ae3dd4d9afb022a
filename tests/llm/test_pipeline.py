import hashlib
import random

import pytest

import corpus_pipeline as C
from shelfprice.llm import decontaminate
from test_decontaminate import want as passages
from test_linededup import brute as line_brute
from test_simhash import brute as component_brute, slow
from test_toxicity import corpus


def documents():
    rnd = random.Random(3)
    rows = [(i, t, y) for i, t, y in corpus(docs=400)]
    clean = [t for _, t, y in rows if not y]
    bench = [(i, " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rnd.randrange(40))
                          for _ in range(30))) for i in range(3)]
    rows += [(400 + i, clean[i], 0) for i in range(20)]                             # copies
    rows += [(430 + i, clean[50 + i] + "\n" + bench[i % 3][1], 0) for i in range(9)]  # leaks
    rows += [(450 + i, "own " + clean[100 + i] + "\n\n" + clean[1], 0) for i in range(9)]  # a repeated line
    rows += [(470, None, 0), (471, "", 0), (472, "  ", 0)]
    return rows, bench


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows, bench = documents()
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t, _ in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), []
    columns = docs.columns
    for k, (_, f) in enumerate(C.STAGES):
        before = docs
        docs = C.landed(f(spark, docs, d), "test")
        out.append((before.collect(), docs.collect()))
        if k < 4:
            assert docs.columns == columns
    return d, out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_toxicity_stage(stages):
    toxic = {i for i, _, y in documents()[0] if y}
    before, after = (set(texts(x)) for x in stages[1][0])
    assert len(before - after & toxic) and len((before - after) & toxic) >= 0.95 * len(toxic)
    assert len((before - after) - toxic) <= 2 and {470, 471, 472} <= after


def test_line_stage(stages):
    before, after = (texts(x) for x in stages[1][1])
    assert after == line_brute(list(before.items()))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in stages[1][1][1])


def test_simhash_stage(stages):
    before, after = (texts(x) for x in stages[1][2])
    want = component_brute([(d, slow(t)) for d, t in before.items()])
    assert set(after) == {want[slow(t)] for t in before.values()} and all(before[d] == t for d, t in after.items())


def test_decontamination_stage(stages):
    before, after = (texts(x) for x in stages[1][3])
    found = passages(documents()[1], [before[d] for d in before])
    assert set(after) == {d for d, f in zip(before, found) if not f} and len(after) < len(before)
    assert decontaminate.Q


def test_token_stage(stages, spark):
    before, after = stages[1][4]
    assert {r.doc_id: r.decoded_sha256 for r in after} == {d: hashlib.sha256((t or "").encode()).hexdigest()
                                                           for d, t in texts(before).items()}
    assert all(r.n_tokens == len(r.ids) for r in after)
    whole = C.run(spark, stages[0])
    assert {(r.doc_id, tuple(r.ids)) for r in whole.collect()} == {(r.doc_id, tuple(r.ids)) for r in after}
