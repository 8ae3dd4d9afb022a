"""Report operators on hand-written rows: first-valid, slots, change, two-key report."""

import datetime as dt

from pyspark.sql import functions as F

from shelfprice.operators.periods import first_valid, keep_first, keep_last, last_n_periods
from shelfprice.plans.reports import (period_long, period_report, weekly_commercial_report,
                                      week_slots)

W = [dt.date(2024, 1, 22), dt.date(2024, 1, 15), dt.date(2024, 1, 8), dt.date(2024, 1, 1)]
SCHEMA = ("article string, description string, category string, article_type string, "
          "unit string, week date, cost double, commercial_cost double, seq int")


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_first_valid_skips_leading_null(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5.0, 2), ("b", None, 1)],
                               "k string, v double, seq int")
    assert sorted(tuple(r) for r in first_valid(df, ["k"], "v", "seq").collect()) == [("a", 5.0)]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 5.0, "x", 1), ("a", None, "y", 2)],
                               "k string, v double, d string, seq int")
    assert [tuple(r) for r in keep_first(df, ["k"], ["v", "d"], "seq").collect()] == [("a", 5.0, "x")]
    # a later null price beats an earlier value
    assert [tuple(r) for r in keep_last(df, ["k"], ["v", "d"], "seq").collect()] == [("a", None, "y")]


def test_last_n_periods(spark):
    df = spark.createDataFrame([(w, i) for i, w in enumerate(W)] + [(None, 9)], "week date, i int")
    got = sorted(r.i for r in last_n_periods(df, "week", 2).collect())
    assert got == [0, 1]


def test_period_change_and_gaps(spark):
    data = [
        ("a", "da", "c", "t", "1", W[0], 110.0, None, 1),
        ("a", "da", "c", "t", "1", W[1], 100.0, None, 2),
        ("b", "db", "c", "t", "2", W[0], 5.0, None, 3),
        ("b", "db", "c", "t", "2", W[1], 0.0, None, 4),
        ("c", "dc", "c", "t", "2", W[0], 7.0, None, 5),
        ("c", "dc", "c", "t", "2", W[2], 7.0, None, 6),   # gap at W[1]: not bridged
        ("z", "dz", "c", "t", "2", W[3], None, None, 7),  # week with only nulls: no slot
    ]
    rep = {r.article: r for r in period_report(rows(spark, data), value="cost", n=4).collect()}
    assert set(rep) == {"a", "b", "c"}
    a, b, c = rep["a"], rep["b"], rep["c"]
    assert (a.wk_0, a.wk_1, a.wk_2) == (110.0, 100.0, None)
    assert abs(a.pct_0 - 0.10) < 1e-12 and a.pct_1 is None and a.dir_0 == 1
    assert b.pct_0 is None and b.prev_zero_0 is True
    assert c.wk_1 is None and c.pct_0 is None and c.pct_1 is None and c.wk_2 == 7.0
    assert a.single_unit is True and b.single_unit is False
    # slot 3 is padded with null: only three weeks have values
    assert all(r.wk_3 is None for r in rep.values())
    long = {(r.article, r.slot): r for r in
            period_long(rows(spark, data), value="cost", n=4).collect()}
    assert long[("c", 0)].prev_value is None
    assert long[("a", 0)].pct_label == "10.000%"


def test_week_slots_bounded(spark):
    data = [("a", "d", "c", "t", "1", w, 1.0, None, i) for i, w in enumerate(W)]
    s = week_slots(rows(spark, data), value="cost", n=2)
    assert sorted((r.week, r.slot) for r in s.collect()) == [(W[1], 1), (W[0], 0)]


def test_two_key_report_uses_first_description(spark):
    data = [
        ("a", "x", "c", "t", "1", W[0], None, 10.0, 1),
        ("a", "y", "c", "t", "1", W[0], None, 20.0, 2),
    ]
    got = weekly_commercial_report(rows(spark, data), n=2).collect()
    assert len(got) == 2
    assert {r.description for r in got} == {"x"}
    assert sorted(r.wk_0 for r in got) == [10.0, 20.0]


def test_report_ignores_input_partitioning(spark):
    data = [("a%d" % (i % 7), "d", "c", "t", "1", W[i % 4], float(i % 13), None, i)
            for i in range(400)]
    df = rows(spark, data)
    base = sorted(map(tuple, period_report(df, value="cost", n=4).collect()), key=str)
    shuffled = df.repartition(13, F.rand(3))
    again = sorted(map(tuple, period_report(shuffled, value="cost", n=4).collect()), key=str)
    assert base == again
