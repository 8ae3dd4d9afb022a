import random

import pytest

from shelfprice.llm import linededup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    """rows (id, text), ids distinct and without null: id -> kept text."""
    seen, out = [], {}
    for d, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            w = line.split()
            near = any(w == v or len(w) >= 8 and len(v) >= 8 and abs(len(w) - len(v)) < 2
                       and distance(w, v) <= 1 for v in seen)
            if not w or not near:
                kept.append(line)
            seen.append(w)
        out[d] = None if text is None else "\n".join(kept)
    return out


def corpus():
    rnd = random.Random(11)
    vocabulary = "a b c d e f g h".split()
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice([7, 8, 9, 15, 16, 17, 31, 32, 33, 40]))] for _ in range(40)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rnd.randrange(6)):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(w))
                edit = rnd.randrange(3)
                if edit == 0:
                    w[at] = rnd.choice(vocabulary)
                elif edit == 1:
                    del w[at]
                else:
                    w.insert(at + rnd.randrange(2), rnd.choice(vocabulary))
            lines.append(rnd.choice(["", "  "]) + " ".join(w) + rnd.choice(["", "\t", "\r"]))
        rows.append((d, "\n".join(lines + [""] * rnd.randrange(3))))
    return rows + [(60, None), (61, ""), (62, "x y"), (63, "x  y\nx z")]


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "s", t) for d, t in rows], "doc_id long, text string, _no string, kept_text string")
    got = linededup.drop_lines(df.repartition(5))
    assert got.columns == df.columns
    made = {r.doc_id: r.text for r in got.collect()}
    want = brute(rows)
    assert made == want
    assert sum(made[d] != t for d, t in rows) > 20


def test_repeated_and_null_ids(spark):
    line = "one two three four five six seven eight nine"
    rows = [(None, line), (1, line + "\nown line"), (1, line + "\nown line"), (1, "own line\n" + line), (0, line + " ten\nz")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted((r["_id"] is not None, r["_id"] or 0, r.kept_text) for r in got)
    # the null id comes first; the equal places of id 1 don't remove each other, but
    # "own line" at its line 0 is earlier than the same words at line 1
    assert kept[0] == (False, 0, line) and (True, 0, "z") in kept
    assert sorted(k[2] for k in kept if k[1] == 1) == ["", "", "own line"]
    assert len(got) == 5


def test_long_text_and_empty_table(spark):
    long = "\n".join(f"w{i} " + "x " * 9 + f"v{i}" for i in range(3000))
    df = spark.createDataFrame([(2, long), (1, long + "\nlast")], "doc_id long, text string")
    made = {r.doc_id: r.text for r in linededup.drop_lines(df).collect()}
    assert made == {1: long + "\nlast", 2: ""}
    assert linededup.drop_lines(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = linededup.drop_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("a,b,near", [("a b c", "a b c", 1), ("a b c", "a x c", 1), ("a b", "a b c", 1), ("b c", "a b c", 1),
                                      ("a a", "a a a", 1), ("a b c", "b a c", 0), ("a c", "a b d", 0), ("a", "a b c", 0)])
def test_edit_distance(spark, a, b, near):
    from pyspark.sql import functions as F
    row = spark.createDataFrame([(a.split(), b.split())], "a array<string>, b array<string>").select(
        linededup.edit_distance_is_one_or_less(F.col("a"), F.col("b")).alias("x"),
        linededup.edit_distance_is_one_or_less(F.col("b"), F.col("a")).alias("y")).first()
    assert (row.x, row.y) == (bool(near), bool(near))


@pytest.mark.parametrize("few", [256, 0])
def test_two_edits_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(linededup, "FEW", few)
    rnd = random.Random(5)
    vocabulary = "a b c d".split()
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice([18, 19, 20, 21, 22, 27, 36, 57, 300]))] for _ in range(25)]
    lines = []
    for _ in range(300):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 1, 1, 2, 3])):
            at = rnd.randrange(len(w))
            w[at:at + rnd.randrange(2)] = [rnd.choice(vocabulary)] * rnd.randrange(2)
        lines.append(w)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(lines)], "doc_id long, text string")
    kept = {}
    for two_from in (None, 20):
        made = {r.doc_id: r.text for r in linededup.drop_lines(df.repartition(3), two_from=two_from).collect()}
        kept[two_from] = {d for d, t in made.items() if t}
    want = {d for d, w in enumerate(lines) if not any(
        abs(len(w) - len(v)) < 3 and distance(w, v) <= (2 if min(len(w), len(v)) >= 20 else 1) for v in lines[:d])}
    assert kept[20] == want and len(kept[None]) > len(want) + 10
    assert linededup.drop_lines(df.limit(0), two_from=20).count() == 0
    with pytest.raises(ValueError):
        linededup.drop_lines(df, two_from=15)


def test_large_group_of_lines_further_apart(spark, monkeypatch):
    """Lines that agree outside two quarters: by variants, without comparing pairs."""
    monkeypatch.setattr(linededup, "FEW", 20)
    rnd = random.Random(8)
    outside = [f"w{i}" for i in range(24)]
    lines = []
    for _ in range(150):
        w = list(outside)
        w[7:11] = [rnd.choice("ab") for _ in range(rnd.randrange(3, 6))]
        w[18:21] = [rnd.choice("abc") for _ in range(rnd.randrange(2, 5))]
        lines.append(w)
    want = {d for d, w in enumerate(lines) if not any(distance(w, v) <= 2 for v in lines[:d])}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(lines)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(linededup, "_variant_pairs", lambda v, f=linededup._variant_pairs: (seen.append(v.count()), f(v))[1])
    made = {r.doc_id for r in linededup.drop_lines(df, two_from=20).collect() if r.text}
    assert made == want and seen[0] > 1000


def test_open_groups_with_shifts_between_neighbouring_quarters(spark, monkeypatch):
    monkeypatch.setattr(linededup, "FEW", 0)
    rnd = random.Random(21)
    base, lines = [f"w{i}" for i in range(24)], []
    for _ in range(120):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4])):
            at = rnd.randrange(4, 14)
            w[at:at + rnd.randrange(2)] = [rnd.choice("ab")] * rnd.randrange(2)
        lines.append(w)
    want = {d for d, w in enumerate(lines) if not any(
        w == v or min(len(w), len(v)) >= 20 and distance(w, v) <= 2 or distance(w, v) <= 1 for v in lines[:d])}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(lines)], "doc_id long, text string")
    assert {r.doc_id for r in linededup.drop_lines(df, two_from=20).collect() if r.text} == want


def test_pipeline_drops_a_line_with_two_words_changed(spark):
    import corpus_pipeline
    line = [f"w{i}" for i in range(57)]
    near = line[:9] + ["new"] + line[10:40] + line[41:]
    df = spark.createDataFrame([(1, " ".join(line)), (2, " ".join(near)), (3, " ".join(near[:-2]))], "doc_id long, text string")
    made = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, df, "").collect()}
    assert made == {1: " ".join(line), 2: "", 3: ""}


def test_pairs_of_a_large_group_grow_no_faster_than_the_group(spark, monkeypatch):
    """Near copies of one long line, up to seven words apart: a third of them is open."""
    rnd = random.Random(4)
    base, lines = [f"w{i}" for i in range(60)], []
    for _ in range(400):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 5, 6, 7])):
            at = rnd.randrange(15, 45)
            w[at:at + rnd.choice([0, 1, 1, 1])] = [f"n{rnd.randrange(150)}"] * rnd.choice([0, 1, 1, 1])
        lines.append(w)
    want = {d for d, w in enumerate(lines) if not any(
        abs(len(w) - len(v)) < 3 and distance(w, v) <= 2 for v in lines[:d])}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(lines)], "doc_id long, text string")
    pairs, distinct = [], type(df).distinct
    monkeypatch.setattr(type(df), "distinct", lambda f: (pairs.append(f.count()) if f.columns == ["_i", "_e"] else None, distinct(f))[1])
    got = {r.doc_id for r in linededup.drop_lines(df, two_from=20).collect() if r.text}
    assert got == want and len(want) > 100
    assert sum(pairs) < 100 * len(lines)
