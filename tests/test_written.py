"""Gates and the weekly refresh on literal rows."""

import datetime as dt

from shelfprice.operators import quality as Q
from shelfprice.operators.grid import cells_from_wide
from shelfprice.plans.weekly import refresh_weekly

T = dt.datetime(2024, 1, 1, 10, 0)


def test_gate_report(spark):
    lists = spark.createDataFrame([(1,), (2,)], "list_id int")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (9, "d")], "list_id int, unit string")
    got = {r.gate: (r.found, r.ok) for r in Q.gate_report(df, "list_id", lists, ["unit", "price"]).collect()}
    assert got == {"require_rows": (4, True), "single_value": (2, False), "require_columns": (1, False),
                   "known_keys": (1, False)}
    empty = {r.gate: (r.found, r.ok) for r in Q.gate_report(df.limit(0), "list_id", lists, ["unit"]).collect()}
    assert empty == {"require_rows": (0, False), "single_value": (0, False), "require_columns": (0, True),
                     "known_keys": (0, True)}


def test_cells_from_wide(spark):
    df = spark.createDataFrame([(4, "a", None, 2.5)], "r int, x string, y string, z double")
    got = [tuple(c) for c in cells_from_wide(df, "r", ["x", "y", "z"], "w", "s", first_col=1).collect()]
    assert got == [("w", "s", 4, 1, "a"), ("w", "s", 4, 3, "2.5")]


def test_weekly_refresh_stops_at_the_first_failure(spark, tmp_path):
    history = spark.createDataFrame([(1, 10, T, 5.0, 1), (1, 10, T + dt.timedelta(days=1), 6.0, 2)],
                                    "id_lista int, cod_art long, fecha timestamp_ntz, precio double, seq int")
    costs = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2.0, 3.0, 1)],
                                  "article string, week date, cost double, commercial_cost double, seq int")
    path = str(tmp_path / "refresh")
    refresh_weekly(spark, history, costs, path, "r1")
    assert [(r.precio, r.n_rows) for r in spark.read.parquet(f"{path}/price_fact").collect()] == [(6.0, 2)]
    assert spark.read.parquet(f"{path}/cost_fact").first().cost == 2.0
    refresh_weekly(spark, history.drop("precio"), costs, str(tmp_path / "bad"), "r2")
    log = spark.read.parquet(str(tmp_path / "bad/run_log")).collect()
    assert [(r.step, r.status) for r in log] == [("price_fact", "ERROR")]


def test_lineitem_moves_once_to_its_customer(spark):
    """Orders meet their customers first; lineitem is exchanged by order alone, whatever is
    too large for a broadcast."""
    import re
    from shelfprice.sources.standins import _line_customer
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _line_customer(spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\bl_extendedprice#", plan)) == 1


def _moved(plans, column):
    import re
    return sum(len(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\b" + column + "#", p)) for p in plans)


def _formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_lineitem_moves_by_order_and_by_part_alone(spark, tmp_path, monkeypatch):
    """The template and the competitor fact exchange lineitem by order and by part, once each;
    the template's top rows come from its landed data rows."""
    from shelfprice.operators import merge as M
    from shelfprice.operators.periods import keep_last
    from shelfprice.session import land
    from shelfprice.sources import grid_standins as GS
    from shelfprice.sources import standins as SI
    monkeypatch.setattr("shelfprice.session.shared_folder", lambda s: str(tmp_path))
    plans = []
    monkeypatch.setattr(GS, "land", lambda df, name: plans.append(_formatted(df)) or land(df, name), raising=False)
    d, key = "/root/testdata/sf0.001", "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    spark.conf.set(key, "8k")  # suppliers, nations and regions go to all tasks
    try:
        rows = GS.template_rows(spark, d)
        plans.append(_formatted(rows))
        fact = keep_last(SI.competitor_fact_rows(spark, d, by_article=True), M.COMPETITOR_KEYS,
                         ["precio", "fecha_modificacion"], "seq").select(*M.COMPETITOR_COLUMNS)
        assert _moved(plans, "l_extendedprice") == 2 and _moved(plans, "l_partkey") == 2
        assert _moved(plans, "values") == 0
        assert _moved([_formatted(fact)], "l_shipdate") == 2 and _moved([_formatted(fact)], "seq") == 0
    finally:
        spark.conf.set(key, kept)
    assert rows.columns == ["workbook", "sheet", "row_idx", "values"]
    # dates on row 1, headers on row 2, of every sheet
    tops = rows.where("row_idx < 3").groupBy("sheet").count().collect()
    assert {r["count"] for r in tops} == {2} and len(tops) == rows.select("sheet").distinct().count()


def test_writes_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    import os
    import time
    from pyspark.sql import functions as F
    from shelfprice.operators import versions as V
    from shelfprice.plans.exports import write_exports
    from shelfprice.session import land
    monkeypatch.setattr("shelfprice.session.shared_folder", lambda s: str(tmp_path))
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for top in dirs for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, old = spark.conf.get(key), files()
    df = spark.range(1000).repartition(4, "id").select("id", (F.col("id") % 3).alias("k"))
    rows = land(df, "rows")
    V.commit(df, str(tmp_path / "table"), ["k"])
    for _ in range(40):  # files go in the background
        if not (left := files() - old):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(key) == setting
    write_exports(df, str(tmp_path / "exports"), ["k"], "2024-06-03")  # counts the rows it has written
    for t in (rows, V.read_table_version(spark, str(tmp_path / "table")), spark.read.parquet(str(tmp_path / "exports"))):
        assert t.count() == 1000
    assert df.count() == 1000 and df.count() == 1000 and spark.conf.get(key) == setting
