"""Refresh of touched weeks, newest partitions by manifest, one write per load outcome."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfprice.operators import periods as P
from shelfprice.operators import versions as V
from shelfprice.plans import competitors as C
from shelfprice.plans import loads as LD
from shelfprice.plans import registry as R
from shelfprice.plans import weekly as WK
from shelfprice.sources import standins as SI

W = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(4)]
COLS = "article string, week date, cost double, commercial_cost double, seq int"


def load(spark, *rows):
    return spark.createDataFrame([(a, w, c, c, s) for a, w, c, s in rows], COLS)


class Killed(BaseException):
    pass


def die():
    raise Killed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_refresh_reads_and_replaces_touched_weeks_only(spark, tmp_path):
    history, fact = str(tmp_path / "h"), str(tmp_path / "f")
    seen = []

    def make(df):
        seen.append(sorted({f.split("week=")[1][:10] for f in df.inputFiles()}))
        return WK.weekly_cost_fact(df)
    first = load(spark, ("a", W[0], 1.0, 1), ("a", W[1], 2.0, 2), ("b", W[1], 3.0, 3), ("b", None, 9.0, 4))
    with pytest.raises(FileNotFoundError):
        WK.refresh_changed(spark, history, fact, make)
    WK.append_load(first, history, "l1")
    WK.refresh_changed(spark, history, fact, make)
    assert WK.refresh_changed(spark, history, fact, make) is None  # nothing new
    # a late correction of one week, and a new week
    second = load(spark, ("a", W[1], 5.0, 9), ("c", W[2], 6.0, 10))
    with pytest.raises(Killed):
        WK.append_load(second, history, "l2", before_switch=die)
    for _ in range(2):  # the load comes again
        WK.append_load(second, history, "l2")
    before = dict(V.current(spark, fact).parts)
    with pytest.raises(Killed):
        WK.refresh_changed(spark, history, fact, make, before_switch=die)
    assert dict(V.current(spark, fact).parts) == before
    WK.refresh_changed(spark, history, fact, make)
    assert seen[1:] == [[str(W[1]), str(W[2])]] * 2
    after = dict(V.current(spark, fact).parts)
    assert after[(str(W[0]),)] == before[(str(W[0]),)]
    whole = WK.weekly_cost_fact(first.union(second))
    made = V.read_table_version(spark, fact).select(*whole.columns)
    assert rows(made) == rows(whole)
    assert V.current(spark, history).notes == {"loads": ["l1", "l2"]}


def test_refresh_after_lost_versions_and_gone_weeks(spark, tmp_path):
    history, fact = str(tmp_path / "h"), str(tmp_path / "f")
    WK.append_load(load(spark, ("a", W[0], 1.0, 1), ("a", W[1], 2.0, 2)), history, "l1")
    WK.refresh_changed(spark, history, fact, WK.weekly_cost_fact)
    V.commit(load(spark), history, replaced=[{"week": W[0]}])  # a week is taken out
    WK.refresh_changed(spark, history, fact, WK.weekly_cost_fact)
    assert [r.week for r in V.read_table_version(spark, fact).collect()] == [W[1]]
    WK.append_load(load(spark, ("b", W[2], 3.0, 3)), history, "l2")
    V.commit(load(spark), history, replaced=[{"week": W[1]}])
    V.clear_versions(spark, history, keep=1, older_than=0)  # the version the fact was made from
    WK.refresh_changed(spark, history, fact, WK.weekly_cost_fact)
    assert [r.week for r in V.read_table_version(spark, fact).collect()] == [W[2]]


def test_weekly_batch_and_log(spark, tmp_path):
    costs, out = str(tmp_path / "c"), str(tmp_path / "out")
    WK.append_load(load(spark, ("a", W[0], 1.0, 1)), costs, "l1")
    prices = spark.createDataFrame([(1, 7, dt.datetime(2024, 1, 2), 5.0, 1)],
                                   "id_lista int, cod_art int, fecha timestamp, precio double, seq int")
    log = WK.refresh_weekly_changed(spark, str(tmp_path / "none"), costs, out)
    assert [(r.step, r.status) for r in log.collect()] == [("price_fact", "ERROR")]
    WK.append_load(prices.withColumn("week", F.lit(W[0])), str(tmp_path / "p"), "l1")
    log = WK.refresh_weekly_changed(spark, str(tmp_path / "p"), costs, out)
    assert sorted((r.step, r.status) for r in log.collect()) == [("cost_fact", "OK"), ("price_fact", "OK")]
    assert V.read_table_version(spark, f"{out}/price_fact").count() == 1


def test_newest_partitions_equal_a_scan(spark, tmp_path):
    data = spark.createDataFrame([(i, i % 2, w) for i, w in enumerate([*W, None, W[3], W[0]])], "k int, g int, week date")
    path = str(tmp_path / "t")
    V.commit(data, path, ["g", "week"])
    for n in (1, 2, 9, None):
        for by in ([], ["g"]):
            got = P.last_n_of_table(spark, path, "week", n, by)
            assert rows(got.select("k", "g", "week")) == rows(P.last_n_periods(data, "week", n, by).select("k", "g", "week"))
    assert len(P.last_n_of_table(spark, path, "week", 1).inputFiles()) == 2
    # integers go by value, not as text; a table that is not partitioned so is scanned
    V.commit(data, str(tmp_path / "i"), ["k"])
    assert rows(P.last_n_of_table(spark, str(tmp_path / "i"), "k", 2).select("k")) == [(5,), (6,)]
    assert rows(P.last_n_of_table(spark, str(tmp_path / "i"), "week", 1).select("k")) == [(3,), (5,)]
    V.commit(data.limit(0), str(tmp_path / "e"), ["week"])
    assert rows(P.last_n_of_table(spark, str(tmp_path / "e"), "week", 3)) == []
    with pytest.raises(FileNotFoundError):
        P.last_n_of_table(spark, str(tmp_path / "none"), "week", 3)


def test_history_outcomes_are_one_write(spark, tmp_path):
    d, path = "/root/testdata/sf0.001", str(tmp_path / "t")
    cells, lists = R._history_cells(spark, d), SI.price_lists(spark, d)
    for _ in range(2):  # a rerun replaces the load
        v = LD.write_history(cells, lists, path)
    load_, rejects = LD.history_load(cells, lists), LD.history_rejects(cells, lists)
    assert rows(LD.written_load(spark, path).select(*load_.columns)) == rows(load_)
    assert rows(LD.written_rejects(spark, path)) == rows(rejects)
    n, told = load_.count(), rejects.where("loaded").count()
    assert told and (v.metrics["rows_loaded"], v.metrics["rows_reported"], v.metrics["rows_rejected"]) == (
        n - told, told, rejects.count() - told)


def test_wide_matrix_groups(spark):
    cell = "cod_art int, description string, category string, article_type string, col_pos int, price double"
    long = spark.createDataFrame([(1, "d", "c", "t", 0, 1.0), (1, "d", "c", "t", 3, 2.0), (1, "d", "c", "t", 4, 3.0),
                                  (2, None, None, None, 1, 4.0)], cell)
    got = rows(C.matrix_wide(long, 2))
    assert got == [(1, "d", "c", "t", 0, 1.0, None), (1, "d", "c", "t", 1, None, 2.0), (1, "d", "c", "t", 2, 3.0, None),
                   (2, None, None, None, 0, None, 4.0)]
