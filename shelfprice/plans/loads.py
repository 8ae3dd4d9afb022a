"""Sheet loads: the dated price-history sheet → price-history fact rows (with
rejects set aside), and the competitor template → competitor fact rows for the
current (year, week) slice."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.dates import calendar_year_iso_week, floor_minute, parse_dayfirst
from shelfprice.functions.text import (blank_to_null, code_or_null, code_or_zero, to_number,
                                       with_clean_price)
from shelfprice.operators import versions as V
from shelfprice.operators.grid import melt_template, unpivot_history
from shelfprice.operators.merge import COMPETITOR_COLUMNS, COMPETITOR_KEYS, HISTORY_COLUMNS
from shelfprice.operators.periods import keep_last
from shelfprice.operators.quality import label_rejects

# Reject rules of the history load, checked in order
HISTORY_REJECT_RULES = ("no_price", "no_code_no_product", "bad_date", "unknown_list")
# Loaded all the same, with code 0, and reported
HISTORY_WARNINGS = ("bad_code",)
# What becomes of a cell: it loads, loads and is reported, or is only reported
HISTORY_OUTCOMES = ("loaded", "reported", "rejected")
REPORT_COLUMNS = ("workbook", "sheet", "row_idx", "col_idx", "price_value", "date_value", "reject_reason")


def _history_parsed(cells: DataFrame) -> DataFrame:
    raw = unpivot_history(cells, parse_date=lambda c: floor_minute(parse_dayfirst(c)))
    code = blank_to_null("cod_text")
    return raw.withColumns({
        "_precio": to_number("price_value"),
        "_code": code,
    }).withColumnRenamed("date_parsed", "_fecha")


def _history_tagged(cells: DataFrame, lists: DataFrame) -> DataFrame:
    """Every history cell with its list and its first failing rule."""
    known = lists.select(F.col("list_name").alias("sheet"), "list_id")
    return label_rejects(_history_parsed(cells).join(known, "sheet", "left"), [
        ("no_price", F.col("_precio").isNull()),
        ("no_code_no_product", F.col("_code").isNull() & F.col("producto").isNull()),
        ("bad_date", F.col("_fecha").isNull()),
        ("unknown_list", F.col("list_id").isNull()),
    ])


def _bad_code() -> Column:
    """True for a cell that loads with code 0 because its code is no number."""
    return F.col("reject_reason").isNull() & F.col("_code").isNotNull() & code_or_null("_code").isNull()


def history_rejects(cells: DataFrame, lists: DataFrame) -> DataFrame:
    """Cells of the history sheets that do not load, with the first failing rule, and
    those that load with code 0 because theirs is no number (``bad_code``, with
    ``loaded`` true)."""
    tagged = _history_tagged(cells, lists)
    return (tagged.withColumn("loaded", F.col("reject_reason").isNull())
            .withColumn("reject_reason", F.when(_bad_code(), "bad_code").otherwise(F.col("reject_reason")))
            .where(F.col("reject_reason").isNotNull()).select(*REPORT_COLUMNS, "loaded"))


def history_load(cells: DataFrame, lists: DataFrame, origin: str = "excel") -> DataFrame:
    """Price-history fact rows (target column order) from history sheets; the
    sheet names the list through ``lists`` (list_id, list_name = sheet)."""
    j = _history_tagged(cells, lists).where(F.col("reject_reason").isNull())
    return j.select(*_fact_columns(origin), F.struct("sheet", "row_idx", "col_idx").alias("seq"))


def _fact_columns(origin: str) -> list[Column]:
    """The target's columns (``HISTORY_COLUMNS``, in order) of a tagged cell that loads."""
    zero = F.lit(0.0)
    return [
        F.lit(origin).alias("origen"), F.col("list_id").alias("id_lista"),
        F.col("sheet").alias("lista"), F.col("_fecha").alias("fecha"),
        F.lit(0).alias("product_id"), code_or_zero("_code").alias("cod_art"),
        F.coalesce(F.col("producto"), F.lit("")).alias("producto"),
        F.col("_precio").alias("precio"), F.lit("").alias("uom"), F.lit("").alias("unidad_me"),
        F.lit("").alias("invoicing_type"), zero.alias("contenido"), zero.alias("box_kgs"),
        zero.alias("precioxkg"), F.col("_fecha").alias("ing_hora")]


def history_outcomes(cells: DataFrame, lists: DataFrame, origin: str = "excel") -> DataFrame:
    """Every history cell once: its ``outcome`` (``HISTORY_OUTCOMES``), the report's columns
    and the target's. What :func:`history_load` and :func:`history_rejects` select, from one
    derivation of the sheets."""
    outcome = F.when(F.col("reject_reason").isNotNull(), "rejected").when(_bad_code(), "reported").otherwise("loaded")
    reason = F.when(_bad_code(), "bad_code").otherwise(F.col("reject_reason")).alias("reject_reason")
    return _history_tagged(cells, lists).select(
        outcome.alias("outcome"), *REPORT_COLUMNS[:-1], reason, *_fact_columns(origin))


def write_history(cells: DataFrame, lists: DataFrame, path: str, origin: str = "excel", before_switch=None) -> V.Version:
    """Write the outcomes of a load once, by outcome, to a table in versions at ``path``; a
    rerun replaces them all. The version's ``metrics`` count each outcome's cells."""
    counts = {f"rows_{o}": F.count(F.when(F.col("outcome") == o, 1)) for o in HISTORY_OUTCOMES}
    return V.commit(history_outcomes(cells, lists, origin), path, ["outcome"], metrics=counts, before_switch=before_switch,
                    replaced=[{"outcome": o} for o in HISTORY_OUTCOMES])


def written_load(spark: SparkSession, path: str) -> DataFrame:
    """The fact rows (and ``seq``) that :func:`write_history` has written."""
    loaded = V.read_table_version(spark, path, partitions=[{"outcome": o} for o in ("loaded", "reported")])
    return loaded.select(*HISTORY_COLUMNS, F.struct("sheet", "row_idx", "col_idx").alias("seq"))


def written_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The report that :func:`write_history` has written."""
    told = V.read_table_version(spark, path, partitions=[{"outcome": o} for o in ("reported", "rejected")])
    return told.select(*REPORT_COLUMNS, (F.col("outcome") == "reported").alias("loaded"))


def template_slices(as_of: str, iso_year: bool = False) -> list[dict[str, int]]:
    """The (year, week) slice that a template load of ``as_of`` replaces."""
    day = datetime.date.fromisoformat(as_of)
    iso = day.isocalendar()
    return [{"anio": iso.year if iso_year else day.year, "semana": iso.week}]


def template_load(grid: DataFrame, sheets: Sequence[str], as_of: str,
                  iso_year: bool = False) -> DataFrame:
    """Competitor fact rows of the ``as_of`` week from the whitelisted template
    sheets (in load order; missing sheets skipped). Repeated row keys keep the
    last value in load order (sheet order, column, row), nulls included."""
    spark = grid.sparkSession
    order = spark.createDataFrame([(s, i) for i, s in enumerate(sheets)],
                                  "sheet string, sheet_rank int")
    # the sheet whitelist is a literal parameter of a few names
    scoped = grid.join(F.broadcast(order), "sheet", "left_semi")
    melted = melt_template(scoped, by_code=True).join(F.broadcast(order), "sheet")
    anio, semana = calendar_year_iso_week(F.lit(as_of).cast("date"), iso_year)
    rows = with_clean_price(melted, "price_value", "precio").select(
        "cod_art", F.col("sheet").alias("cluster"), "competencia",
        "precio", anio.alias("anio"), semana.alias("semana"),
        "fecha_modificacion", F.struct("sheet_rank", "col_idx", "row_idx").alias("seq"))
    return keep_last(rows, COMPETITOR_KEYS, ["precio", "fecha_modificacion"], "seq").select(
        *COMPETITOR_COLUMNS)
