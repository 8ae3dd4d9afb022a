"""Scalar column functions against hand-written edge rows (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfprice.functions import dates as FD
from shelfprice.functions import flags as FL
from shelfprice.functions import text as FT


def one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_clean_price_text(spark):
    got = one_col(spark, ["$ 1.234,56", "1.234", "1,5", "1.234.567", "", "0", "abc", None,
                          "-3", " $ 12 ", "1e15", "nan", "inf", "1_0"], "string", FT.clean_price)
    assert got == [Decimal("1234.5600"), Decimal("1.2340"), Decimal("1.5000"), None, None, None,
                   None, None, Decimal("-3.0000"), Decimal("12.0000"), None, None, None, None]


def test_clean_price_number(spark):
    got = one_col(spark, [-3.0, 0.0, 1e15, 94.67875, 2.5], "double", FT.clean_price_number)
    assert got == [Decimal("-3.0000"), None, None, Decimal("94.6787"), Decimal("2.5000")]


def test_round_half_even(spark):
    vals = [0.5, 1.5, 2.5, -0.5, -1.5, 2.4999999]
    assert one_col(spark, vals, "double", lambda c: FL.round_half_even(c, 0)) == \
        [0.0, 2.0, 2.0, -0.0, -2.0, 2.0]
    assert one_col(spark, vals, "double", lambda c: FL.round_half_even_exact(c, 0)) == \
        [0.0, 2.0, 2.0, -0.0, -2.0, 2.0]


def test_round_exact_matches_python(spark):
    import random
    random.seed(7)
    vals = [round(random.uniform(-1e4, 1e4), 5) for _ in range(3000)] + [94.67875, 2.675, 1.00005]
    got = one_col(spark, vals, "double", lambda c: FL.round_half_even_exact(c, 4))
    assert got == [round(v, 4) for v in vals]


def test_normalise_ratio(spark):
    got = one_col(spark, ["12,5%", "0.5%", "-3", "abc", None, "0,125"], "string", FT.normalise_ratio)
    assert got[3:5] == [None, None]
    assert got[:3] + got[5:] == pytest.approx([0.125, 0.5, -0.03, 0.125])


def test_to_number_strictness(spark):
    got = one_col(spark, [" 12 ", "5d", "1_0", "NaN", "inf", ".5", "-1e3", ""], "string", FT.to_number)
    assert got == [12.0, None, None, None, None, 0.5, -1000.0, None]


def test_code_coercion(spark):
    assert one_col(spark, ["12.7", "x", None, " 8 ", "-3.9"], "string", FT.code_or_zero) == \
        [12, 0, 0, 8, -3]
    assert one_col(spark, ["12.7", "x", None], "string", FT.code_or_null) == [12, None, None]


def test_keys_and_names(spark):
    assert one_col(spark, ["  Sin   IVA ", None, "RUBRO"], "string", FT.norm_key) == \
        ["sin iva", "", "rubro"]
    assert one_col(spark, [" a/b:c*d? ", 'x"<y>|z\\w'], "string", FT.safe_name) == \
        ["a_b_c_d_", "x__y__z_w"]
    assert one_col(spark, ["CLUSTER NORTE", "Mayoristas CLUSTER"], "string",
                   FT.strip_cluster_word) == ["NORTE", "Mayoristas"]
    assert one_col(spark, [None, " nan ", " x "], "string", FT.clean_str) == ["", "", "x"]
    assert one_col(spark, ["a; b,,c ", "", None], "string", FT.split_list) == \
        [["a", "b", "c"], [], []]


def test_direction_and_labels(spark):
    assert one_col(spark, [1e-7, 0.0125, -0.2, None], "double", FL.direction) == [0, 1, -1, None]
    assert one_col(spark, [0.125, None, -0.558125], "double", FL.pct_label) == \
        ["12.500%", "", "-55.812%"]


def test_flags(spark):
    assert one_col(spark, [199.0, -199.0, 1990.0, 99.7], "double", FL.ends_in_99) == \
        [True, True, False, True]
    assert one_col(spark, ["1.9", "2", "x", None], "string", FL.single_unit_numeric) == \
        [True, False, False, False]
    assert one_col(spark, ["1-Unit", "10-Box", " 1-kg"], "string", FL.single_unit_text) == \
        [True, False, True]
    assert one_col(spark, [-0.2, 0.0, 3.0, None], "double", FL.sign_class) == [-1, 0, 1, None]


def test_valid_price_round_first(spark):
    df = spark.createDataFrame([("0.4",), ("0",), ("12.6",), ("x",)], "v string")
    v1, k1 = FL.valid_price("v", round_first=True)
    v2, k2 = FL.valid_price("v", round_first=False)
    assert [r[0] for r in df.select(k1).collect()] == [False, False, True, False]
    assert [r[0] for r in df.select(k2).collect()] == [True, False, True, False]


def test_dates(spark):
    got = one_col(spark, ["5/1/1999", "05/01/1999 7:05", "1999-01-05 07:05:09", "31/2/1999",
                          "junio", None], "string", FD.parse_dayfirst)
    assert got == [dt.datetime(1999, 1, 5), dt.datetime(1999, 1, 5, 7, 5),
                   dt.datetime(1999, 1, 5, 7, 5, 9), None, None, None]
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2027, 1, 1),)], "d date")
    y, w = FD.calendar_year_iso_week("d")
    iy, _ = FD.calendar_year_iso_week("d", iso_year=True)
    assert [tuple(r) for r in df.select(y, w, iy).collect()] == [(2024, 1, 2025), (2027, 53, 2026)]
    assert [r[0] for r in df.select(FD.week_label("d")).collect()] == ["30-dec", "01-jan"]
    assert [r[0] for r in df.select(FD.date_text("d")).collect()] == ["30/12/2024", "01/01/2027"]


def test_percent_label_of_the_exact_value(spark):
    # 40001 / 40000 and 200001 / 200000 are stored just above the tie
    x = [40001 / 40000 - 1, (40001.0 - 40000.0) / 40000.0, (200001.0 - 200000.0) / 200000.0, -0.000004, 0.0]
    assert one_col(spark, x, "double", FL.pct_label) == [f"{v:.3%}" for v in x]
    assert one_col(spark, x, "double", FL.direction) == [
        (float(f"{v:.3%}"[:-1]) > 0) - (float(f"{v:.3%}"[:-1]) < 0) for v in x]


def test_dates_by_text_and_type(spark):
    import datetime as dt
    texts = ["2024-01-02 03:04:05.5", "2024-01-02T03:04:05.250", "5/1/24", "5-1-2024 10:30", "2024/01/05",
             "05.01.2024 10:30", " 1/2/2024 ", "31/2/2024", "5/1-2024", "1/13/2024", "", "junio", None, "5/1/99"]
    d = dt.datetime
    assert one_col(spark, texts, "string", FD.parse_dayfirst) == [
        d(2024, 1, 2, 3, 4, 5, 500000), d(2024, 1, 2, 3, 4, 5, 250000), d(2024, 1, 5), d(2024, 1, 5, 10, 30),
        d(2024, 1, 5), d(2024, 1, 5, 10, 30), d(2024, 2, 1), None, None, None, None, None, None, d(1999, 1, 5)]
    stamps = [d(2024, 3, 10, 2, 30, 0, 500000)]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert one_col(spark, stamps, "timestamp_ntz", FD.parse_dayfirst) == stamps
        assert one_col(spark, ["10/3/2024 2:30"], "string", FD.parse_dayfirst) == [d(2024, 3, 10, 2, 30)]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one_col(spark, [dt.date(2024, 3, 10)], "date", FD.parse_dayfirst) == [d(2024, 3, 10)]
