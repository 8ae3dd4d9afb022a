"""Report sinks, run log, export and merge writers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfprice.operators import merge as M
from shelfprice.operators import versions as V
from shelfprice.plans import exports as EX
from shelfprice.plans.publish import publish_report
from shelfprice.plans.weekly import run_steps

T = dt.datetime(2024, 1, 1, 10, 0)
HIST = ("origen string, id_lista int, lista string, fecha timestamp_ntz, product_id int, "
        "cod_art long, producto string, precio double, uom string, unidad_me string, "
        "invoicing_type string, contenido double, box_kgs double, precioxkg double, "
        "ing_hora timestamp_ntz")


def hist_rows(spark, rows):
    return spark.createDataFrame(
        [("x", lst, "L", ts, 0, code, "p", price, "", "", "", 0.0, 0.0, 0.0, ts)
         for lst, code, ts, price in rows], HIST)


def test_publish_report_idempotent(spark, tmp_path):
    rep = spark.createDataFrame([("a", 1.0)], "article string, wk_0 double")
    hdr = spark.createDataFrame([(0, dt.date(2024, 1, 1), "01-jan")], "slot int, week date, week_label string")
    path = str(tmp_path / "reports")
    publish_report(rep, hdr, path, "costs", "Costos", 4)
    publish_report(rep, hdr, path, "costs", "Costos", 4)
    rows = spark.read.parquet(f"{path}/rows").collect()
    assert len(rows) == 1 and rows[0].title == "Costos" and rows[0].n_weeks == 4


def test_run_log_stops_at_first_failure(spark, tmp_path):
    seen = []

    def boom():
        raise RuntimeError("procedure failed")

    log = str(tmp_path / "run_log")
    run_steps(spark, [("prices", lambda: seen.append(1)), ("costs", boom),
                      ("never", lambda: seen.append(2))], log, run_id="r1")
    got = sorted((r.step, r.status) for r in spark.read.parquet(log).collect())
    assert got == [("costs", "ERROR"), ("prices", "OK")] and seen == [1]


def test_export_writer_replaces_the_whole_date(spark, tmp_path):
    df = spark.createDataFrame([("NORTE", "Carnes", "7", 1.5), ("NORTE", "Dira", "8", 2.5)],
                               "cluster string, category string, codigo string, precio double")
    path = str(tmp_path / "exports")
    keys = ["cluster", "category"]
    EX.write_exports(df, path, keys, "2024-06-03")
    EX.write_exports(df, path, keys, "2024-06-04")
    # rerun without the Dira group: its earlier file is gone, the other date stays
    EX.write_exports(df.where("category = 'Carnes'"), path, keys, "2024-06-03")
    got = sorted((str(r.process_date), r.category) for r in spark.read.parquet(path).collect())
    assert got == [("2024-06-03", "Carnes"), ("2024-06-04", "Carnes"), ("2024-06-04", "Dira")]
    assert not os.path.exists(f"{path}/process_date=2024-06-03/cluster=NORTE/category=Dira")


def test_sales_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("NORTE", "Carnes", "PubN", "w", "s", 0, 5, "8", 2.5), ("NORTE", "Carnes", "PubN", "w", "s", 0, 4, "7", 1234.5),
         ("SUR", "Dira", "", "w", "s", 3, 4, "9", 1.0)],
        "cluster string, category string, list_code string, workbook string, sheet string, block_start int, "
        "row_idx long, codigo string, precio double") \
        .withColumns({"cero": F.lit(0.0), "fecha_texto": F.lit("1/1/2019")})
    path = str(tmp_path / "sales")
    for _ in range(2):
        EX.write_sales_files(df, path, "2024-06-03")
    folder = f"{path}/process_date=2024-06-03/cluster=NORTE/category=Carnes"
    files = [f for f in os.listdir(folder) if f.endswith(".csv")]
    assert len(files) == 1
    with open(f"{folder}/{files[0]}") as f:
        assert f.read().splitlines() == ["PubN,,,", "7,1234.5,0.00,1/1/2019", "8,2.5,0.00,1/1/2019"]
    got = sorted((r.cluster, r.category, r.n_rows) for r in EX.written_manifest(spark, path, "2024-06-03").collect())
    assert got == [("NORTE", "Carnes", 2), ("SUR", "Dira", 1)]
    back = sorted(tuple(r) for r in EX.written_lines(spark, path, "2024-06-03").where("cluster = 'NORTE'").collect())
    assert [(r[2], r[3], r[4]) for r in back] == [(0, "PubN", None), (1, "7", "1234.5"), (2, "8", "2.5")]


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "hist")
    V.commit(hist_rows(spark, [(1, 10, T, 5.0), (2, 20, T, 6.0)]), path, ["id_lista"])
    src = hist_rows(spark, [(1, 10, T, 7.0), (1, 11, T, 8.0)]).withColumn("seq", F.lit(1))
    assert M.touched_slices(src, ["id_lista"]) == [{"id_lista": 1}]
    assert all("id_lista=1" in f for f in V.read_table_version(spark, path, partitions=[{"id_lista": 1}]).inputFiles())
    for _ in range(2):
        M.write_upsert(spark, path, src, M.HISTORY_KEYS, M.HISTORY_UPDATE_COLS, "seq")
    got = sorted((r.id_lista, r.cod_art, r.precio) for r in V.read_table_version(spark, path).collect())
    assert got == [(1, 10, 7.0), (1, 11, 8.0), (2, 20, 6.0)]
    for n in (2, 0):  # a rerun inserts nothing
        v = M.write_insert_only(spark, path, src.withColumn("cod_art", F.col("cod_art") + 5), M.HISTORY_KEYS, "seq")
        assert v.metrics["rows_written"] == n
    assert V.read_table_version(spark, path).count() == 5


def test_a_failing_export_leaves_the_date_as_it_was(spark, tmp_path):
    df = spark.createDataFrame([("NORTE", "Carnes", "7", 1.5)], "cluster string, category string, codigo string, precio double")
    path, keys = str(tmp_path / "exports"), ["cluster", "category"]
    EX.write_exports(df, path, keys, "2024-06-03")
    with pytest.raises(Exception, match="no such code"):
        EX.write_exports(df.withColumn("codigo", F.raise_error(F.lit("no such code")).cast("string")), path, keys, "2024-06-03")
    assert os.listdir(path) == ["process_date=2024-06-03"]
    assert [r.codigo for r in spark.read.parquet(path).collect()] == ["7"]
    # an export that reads the date it replaces
    EX.write_exports(spark.read.parquet(path).drop("process_date").withColumn("precio", F.lit(9.0)), path, keys, "2024-06-03")
    assert [r.precio for r in spark.read.parquet(path).collect()] == [9.0]
    EX.write_exports(df.limit(0), path, keys, "2024-06-03")
    assert os.listdir(path) == []


def test_prices_keep_their_digits(spark):
    got = [r.t for r in spark.createDataFrame([(1234.567,), (5.0,), (0.1,), (98765432.25,), (-3.5,), (1000.0,)], "x double")
           .select(EX.plain_number(F.col("x")).alias("t")).collect()]
    assert got[:3] == ["1234.567", "5", "0.1"] and got[4:] == ["-3.5", "1000"] and float(got[3]) == 98765432.25


def test_replace_slices(spark):
    old = spark.createDataFrame([(1, 2023, 5), (2, 2024, 1), (3, None, 1)], "x int, anio int, semana int")
    new = spark.createDataFrame([(9, 2024, 1)], "x int, anio int, semana int")
    got = M.replace_slices(old, new, [{"anio": 2024, "semana": 1}])
    assert sorted(r.x for r in got.collect()) == [1, 3, 9]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert M.replace_slices(old, new, []).count() == 3


def test_run_log_keeps_the_whole_message(spark, tmp_path):
    def boom():
        raise RuntimeError("x" * 5000)
    log = str(tmp_path / "log")
    run_steps(spark, [("prices", boom)], log, run_id="r")
    assert len(spark.read.parquet(log).first().message) == 5000


def test_sales_lines_of_a_group_over_several_files(spark, tmp_path):
    """A group of more lines than a task should hold is cut into files that continue each
    other; its lines are numbered without a window over them."""
    df = spark.range(5000).select(
        F.lit("SUR").alias("cluster"), F.when(F.col("id") < 4900, "Carnes").otherwise("Dira").alias("category"),
        F.lit("L").alias("list_code"), F.lit("w").alias("workbook"), F.lit("s").alias("sheet"), F.lit(0).alias("block_start"),
        (9999 - F.col("id")).alias("row_idx"), F.col("id").cast("string").alias("codigo"), F.lit(2.5).alias("precio"),
        F.lit(0.0).alias("cero"), F.lit("d").alias("fecha_texto"))
    path = str(tmp_path / "sales")
    EX.write_sales_files(df, path, "2024-06-03", lines_per_task=1000)
    files = sorted(f for f in os.listdir(f"{path}/process_date=2024-06-03/cluster=SUR/category=Carnes") if f.endswith(".csv"))
    assert len(files) >= 4
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # files in several read splits
    try:
        back = EX.written_lines(spark, path, "2024-06-03")
        got = sorted((r.category, r.line, r.a) for r in back.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted([("Carnes", 0, "L"), ("Dira", 0, "L")] + [("Carnes", 4900 - i, str(i)) for i in range(4900)]
                         + [("Dira", 5000 - i, str(i)) for i in range(4900, 5000)])
    assert [(r.category, r.n_rows) for r in EX.written_manifest(spark, path, "2024-06-03").orderBy("category").collect()] == \
        [("Carnes", 4900), ("Dira", 100)]
