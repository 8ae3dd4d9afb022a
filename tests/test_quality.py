"""Data-quality gates and a property test of price-text cleaning."""

import re
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfprice.functions.text import clean_price, with_clean_price
from shelfprice.operators import quality as Q
from shelfprice.plans.reports import price_list_report


def test_require_rows_and_single_value(spark):
    empty = spark.createDataFrame([], "list_id int")
    with pytest.raises(Q.DataQualityError):
        Q.require_rows(empty)
    two = spark.createDataFrame([(1,), (2,), (None,)], "list_id int")
    with pytest.raises(Q.DataQualityError):
        Q.single_value(two, "list_id")
    one = spark.createDataFrame([(3,), (3,), (None,)], "list_id int")
    assert Q.single_value(one, "list_id") == 3
    with pytest.raises(Q.DataQualityError):
        Q.require_columns(one, ["unit"])


def test_unknown_keys_and_profile(spark):
    rows = spark.createDataFrame([(1, "a"), (9, "b"), (1, "c")], "list_id int, article string")
    dim = spark.createDataFrame([(1, "L1")], "list_id int, list_name string")
    assert [r.list_id for r in Q.unknown_keys(rows, dim, ["list_id"]).collect()] == [9]
    p = Q.profile(rows, "list_id").first()
    assert (p.n_rows, p.n_distinct) == (3, 2)


def test_split_rejects_first_rule_wins(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, None, None), (2, 5.0, None), (3, 5.0, "x")],
                               "id int, price double, code string")
    ok, bad = Q.split_rejects(df, [("no_price", F.col("price").isNull()),
                                   ("no_code", F.col("code").isNull())])
    assert [r.id for r in ok.collect()] == [3]
    assert sorted((r.id, r.reject_reason) for r in bad.collect()) == [(1, "no_price"), (2, "no_code")]


def test_price_list_validation(spark):
    import datetime as dt
    rows = spark.createDataFrame(
        [(2, "a", "d", "c", "t", "1-u", dt.date(2024, 1, 1), 10.0, 1)],
        "list_id int, article string, description string, category string, "
        "article_type string, unit string, week date, price double, seq int")
    lists = spark.createDataFrame([(2, "L2")], "list_id int, list_name string")
    assert price_list_report(rows, n=2, list_id=2, lists=lists, validate=True).count() == 1
    with pytest.raises(Q.DataQualityError):
        price_list_report(rows, n=2, list_id=3, lists=lists, validate=True)


# ---------------------------------------------------------------- property test

def model_clean_price(text):
    """Independent model of the price-text rules (pure Python, Decimal)."""
    if text is None:
        return None
    s = text.strip()
    if s == "":
        return None
    s = s.replace("$", "").replace(" ", "")
    if "," in s and "." in s:
        s = s.replace(".", "").replace(",", ".")
    elif "," in s:
        s = s.replace(",", ".")
    if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s):
        return None
    v = float(s)
    if v == 0:
        return None
    r = round(v, 4)
    if abs(r) > 99999999999999.9999:
        return None
    return Decimal(repr(r)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_EVEN)


price_text = st.one_of(
    st.none(),
    st.from_regex(r"\A ?\$? ?-?[0-9]{1,7}([.,][0-9]{1,6})? ?\Z", fullmatch=True),
    st.from_regex(r"\A-?[0-9]{1,3}(\.[0-9]{3}){1,2},[0-9]{1,3}\Z", fullmatch=True),
    st.sampled_from(["", "0", "abc", "1.234.567", "1,5", "nan", "1e3", "  "]),
)


@settings(max_examples=30, deadline=None)
@given(st.lists(price_text, min_size=1, max_size=40))
def test_clean_price_matches_model(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.p for r in with_clean_price(df, "t", "p").orderBy("i").collect()]
    direct = [r.p for r in df.orderBy("i").select(clean_price("t").alias("p")).collect()]
    assert got == direct == [model_clean_price(t) for t in texts]
