"""Tables in versions: what a failed, repeated or concurrent write leaves."""

import pytest
from pyspark.sql import functions as F

from shelfprice.operators import merge as M
from shelfprice.operators import versions as V

SCHEMA = "k int, p string, x double"


def df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(spark, path, number=None, **kw):
    return sorted((tuple(r) for r in V.read_table_version(spark, path, number, **kw).collect()), key=str)


class Killed(BaseException):
    pass


def die():
    raise Killed


def test_replaces_partitions_and_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        V.read_table_version(spark, path)
    V.commit(df(spark, (1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (4, "x/y=z", 4.0)), path, ["p"])
    v = V.commit(df(spark, (5, "a", 5.0)), path)
    assert v.number == 1 and v.metrics["rows_written"] == 1
    assert rows(spark, path) == [(2, "b", 2.0), (3, None, 3.0), (4, "x/y=z", 4.0), (5, "a", 5.0)]
    assert rows(spark, path, 0) == [(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (4, "x/y=z", 4.0)]
    # a slice without rows in the new load goes, too
    V.commit(df(spark, (6, "a", 6.0)), path, replaced=[{"p": "b"}, {"p": None}])
    assert rows(spark, path) == [(4, "x/y=z", 4.0), (6, "a", 6.0)]
    assert rows(spark, path, partitions=[{"p": "a"}, {"p": "none"}]) == [(6, "a", 6.0)]
    V.commit(df(spark, (7, "a", 7.0)), path, append=True)
    assert rows(spark, path) == [(4, "x/y=z", 4.0), (6, "a", 6.0), (7, "a", 7.0)]


def test_a_killed_writer_leaves_the_old_state(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit(df(spark, (1, "a", 1.0)), path, ["p"])
    with pytest.raises(Killed):
        V.commit(df(spark, (2, "a", 2.0)), path, before_switch=die)
    assert rows(spark, path) == [(1, "a", 1.0)] and V.version_numbers(spark, path) == [0]
    V.commit(df(spark, (2, "a", 2.0)), path)
    assert rows(spark, path) == [(2, "a", 2.0)]
    # what the dead writer and the version before left goes when it is old enough
    assert V.clear_versions(spark, path, keep=1) == []
    assert len(V.clear_versions(spark, path, keep=1, older_than=-60)) == 2
    assert rows(spark, path) == [(2, "a", 2.0)] and V.version_numbers(spark, path) == [1]


def test_of_two_writers_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit(df(spark, (1, "a", 1.0)), path, ["p"])
    with pytest.raises(V.VersionConflict):
        V.commit(df(spark, (2, "a", 2.0)), path, before_switch=lambda: V.commit(df(spark, (3, "a", 3.0)), path))
    assert rows(spark, path) == [(3, "a", 3.0)] and V.version_numbers(spark, path) == [0, 1]


def test_without_partitions_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit(df(spark, (1, "a", 1.0)), path)
    V.commit(df(spark), path)
    assert rows(spark, path) == []
    V.commit(df(spark, (2, None, None)), path, append=True)
    assert rows(spark, path) == [(2, None, None)]


def test_reads_only_the_partitions_asked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit(df(spark, *[(i, f"p{i}", 0.0) for i in range(9)]), path, ["p"])
    some = V.read_table_version(spark, path, partitions=[{"p": "p3"}])
    assert len(some.inputFiles()) == 1 and [r.k for r in some.collect()] == [3]


def test_upsert_is_atomic_and_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    V.commit(df(spark, (1, "a", 1.0), (2, "b", 2.0)), path, ["p"])
    source = df(spark, (1, "a", 10.0), (1, "a", 11.0), (9, "a", 9.0), (8, "c", 8.0)).withColumn("seq", F.col("x"))
    args = (spark, path, source, ["k", "p"], ["x"], "seq")
    with pytest.raises(Killed):
        M.write_upsert(*args, before_switch=die)
    assert rows(spark, path) == [(1, "a", 1.0), (2, "b", 2.0)]
    counts = [M.write_upsert(*args).metrics for _ in range(2)]
    assert rows(spark, path) == [(1, "a", 11.0), (2, "b", 2.0), (8, "c", 8.0), (9, "a", 9.0)]
    for found, inserted in zip(counts, (2, 0)):
        assert (found["rows_total"], found["rows_inserted"], found["rows_updated"]) == (4, inserted, 4 - inserted)
    stats = M.merge_stats(df(spark, (1, "a", 1.0), (2, "b", 2.0)), source, ["k", "p"]).where("mode = 'upsert'").first()
    assert (stats.rows_total, stats.rows_inserted, stats.rows_updated) == (4, 2, 2)
    # a load of one partition leaves the files of the others alone
    before = {f for _, f in V.current(spark, path).parts if "p=b" in f}
    assert before == {f for _, f in V.current(spark, path, 0).parts if "p=b" in f}


def test_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    M.write_slices(df(spark, (1, "a", 1.0), (2, "b", 2.0)), path, ["p"])
    assert M.write_slices(df(spark), path, ["p"], [{"p": "a"}]) is None
    assert rows(spark, path) == [(1, "a", 1.0), (2, "b", 2.0)]
    with pytest.raises(Killed):
        M.write_slices(df(spark, (3, "a", 3.0)), path, ["p"], before_switch=die)
    for _ in range(2):
        M.write_slices(df(spark, (3, "a", 3.0)), path, ["p"], [{"p": "a"}])
        assert rows(spark, path) == [(2, "b", 2.0), (3, "a", 3.0)]
