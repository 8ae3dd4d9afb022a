"""Merges, load counts, slice replacement and their write paths."""

import datetime as dt

from pyspark.sql import functions as F

from shelfprice.operators import merge as M
from shelfprice.operators import versions as V

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k int, producto string, precio double, seq int"


def test_insert_only_keeps_first(spark):
    target = spark.createDataFrame([(1, "old", 1.0)], "k int, producto string, precio double")
    src = spark.createDataFrame([(2, "p", 5.0, 1), (2, "q", 7.0, 2), (1, "z", 9.0, 3)], SCHEMA)
    got = sorted(tuple(r) for r in M.merge_insert_only(target, src, ["k"], "seq").collect())
    assert got == [(1, "old", 1.0), (2, "p", 5.0)]


def test_upsert_first_descriptive_last_price(spark):
    target = spark.createDataFrame([(1, "old", 1.0)], "k int, producto string, precio double")
    src = spark.createDataFrame([(2, "p", 5.0, 1), (2, "q", 7.0, 2), (1, "z", 9.0, 3)], SCHEMA)
    got = sorted(tuple(r) for r in
                 M.merge_upsert(target, src, ["k"], ["precio"], "seq").collect())
    assert got == [(1, "old", 9.0), (2, "p", 7.0)]


def test_merge_stats_counts(spark):
    target = spark.createDataFrame([(1, "old", 1.0)], "k int, producto string, precio double")
    src = spark.createDataFrame([(2, "p", 5.0, 1), (2, "q", 7.0, 2), (1, "z", 9.0, 3)], SCHEMA)
    both = {r["mode"]: r for r in M.merge_stats(target, src, ["k"]).collect()}
    up, ins = both["upsert"], both["insert_only"]
    assert (up.rows_total, up.rows_inserted, up.rows_updated, up.rows_skipped) == (3, 1, 2, 0)
    assert (ins.rows_total, ins.rows_inserted, ins.rows_updated, ins.rows_skipped) == (3, 1, 0, 2)
    assert up.rows_inserted + up.rows_updated == up.rows_total


def test_replace_slices_state(spark):
    existing = spark.createDataFrame([(1, 2024, 1, 1.0), (2, 2024, 2, 2.0)],
                                     "k int, anio int, semana int, p double")
    new = spark.createDataFrame([(3, 2024, 2, 3.0)], "k int, anio int, semana int, p double")
    week = [{"anio": 2024, "semana": 2}]
    got = sorted(tuple(r) for r in M.replace_slices(existing, new, M.load_slices(new, week)).collect())
    assert got == [(1, 2024, 1, 1.0), (3, 2024, 2, 3.0)]
    empty = new.limit(0)
    same = sorted(tuple(r) for r in M.replace_slices(existing, empty, M.load_slices(empty, week)).collect())
    assert same == [(1, 2024, 1, 1.0), (2, 2024, 2, 2.0)]


def _state(spark, path):
    return sorted(tuple(r) for r in V.read_table_version(spark, path).select("k", "anio", "semana", "p").collect())


def test_write_slices_idempotent(spark, tmp_path):
    path = str(tmp_path / "fact")
    base = spark.createDataFrame([(1, 2024, 1, 1.0), (2, 2024, 2, 2.0)],
                                 "k int, anio int, semana int, p double")
    M.write_slices(base, path, ["anio", "semana"])
    new = spark.createDataFrame([(3, 2024, 2, 3.0)], "k int, anio int, semana int, p double")
    M.write_slices(new, path, ["anio", "semana"])
    first = _state(spark, path)
    M.write_slices(new, path, ["anio", "semana"])
    assert _state(spark, path) == first == [(1, 2024, 1, 1.0), (3, 2024, 2, 3.0)]
    M.write_slices(new.limit(0), path, ["anio", "semana"])   # empty load: nothing changes
    assert _state(spark, path) == first


def test_write_insert_only_and_upsert(spark, tmp_path):
    path = str(tmp_path / "hist")
    schema = "id_lista int, cod_art long, fecha timestamp_ntz, producto string, precio double"
    target = spark.createDataFrame([(1, 10, T0, "a", 1.0)], schema)
    V.commit(target, path, ["id_lista"])
    src = spark.createDataFrame([(1, 10, T0, "b", 2.0, 1), (1, 11, T0, "c", 3.0, 2),
                                 (1, 11, T0, "d", 4.0, 3)], schema + ", seq int")
    keys = ["id_lista", "cod_art", "fecha"]
    M.write_insert_only(spark, path, src, keys, "seq")
    M.write_insert_only(spark, path, src, keys, "seq")   # second run inserts 0
    got = sorted((r.cod_art, r.producto, r.precio) for r in V.read_table_version(spark, path).collect())
    assert got == [(10, "a", 1.0), (11, "c", 3.0)]
    M.write_upsert(spark, path, src, keys, ["precio"], "seq")
    got = sorted((r.cod_art, r.producto, r.precio) for r in V.read_table_version(spark, path).collect())
    assert got == [(10, "a", 2.0), (11, "c", 4.0)]
