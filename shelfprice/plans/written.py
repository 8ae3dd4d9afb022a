"""Registered queries of the sinks: each writes to a target of its own under the
session's warehouse folder, reads it back and returns what it read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.dates import week_start
from shelfprice.operators import merge as M
from shelfprice.operators import quality as Q
from shelfprice.operators import versions as V
from shelfprice.operators.grid import cells_from_wide
from shelfprice.operators.periods import keep_last, last_n_of_table, last_n_periods
from shelfprice.plans import competitors as C
from shelfprice.plans import exports as EX
from shelfprice.plans import loads as LD
from shelfprice.plans import publish as PB
from shelfprice.plans import registry as R
from shelfprice.plans import reports as RP
from shelfprice.plans import weekly as WK
from shelfprice.session import land
from shelfprice.sources import standins as SI
from shelfprice.sources import standins_sql as S
from shelfprice.sources.tables import read_table


def target(spark: SparkSession, name: str) -> str:
    """A new folder under the warehouse."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shelfprice/{name}-{uuid.uuid4().hex}"


@R.register("land_wide_sheet", """
SELECT 'parts' AS workbook, 'list' AS sheet, CAST(p_partkey AS BIGINT) AS row_idx, CAST(c AS INTEGER) AS col_idx, v AS value
FROM (SELECT p_partkey, unnest([2, 3, 4]) AS c,
             unnest([p_name, CASE WHEN p_size > 40 THEN NULL ELSE p_brand END, CAST(p_size AS VARCHAR)]) AS v FROM part)
WHERE v IS NOT NULL
""")
def q_land_wide_sheet(spark, d):
    wide = read_table(spark, d, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_size") <= 40, F.col("p_brand")).alias("b"), "p_size")
    return cells_from_wide(wide, "p_partkey", ["p_name", "b", "p_size"], "parts", "list", first_col=2)


@R.register("load_gates", f"""{S.with_ctes(S.PRICE_LISTS, S.LINE_CUSTOMER, S.WEEKLY_PRICE_ROWS)},
c AS (SELECT count(*) AS n, count(DISTINCT list_id) AS k,
             count(DISTINCT CASE WHEN list_id NOT IN (SELECT list_id FROM price_lists WHERE list_id <> 2) THEN list_id END) AS u
      FROM weekly_price_rows)
SELECT 'require_rows' AS gate, n AS found, n > 0 AS ok FROM c
UNION ALL SELECT 'single_value', k, k = 1 FROM c
UNION ALL SELECT 'require_columns', 1, false FROM c
UNION ALL SELECT 'known_keys', u, u = 0 FROM c
""")
def q_load_gates(spark, d):
    lists = SI.price_lists(spark, d).where("list_id <> 2")
    return Q.gate_report(SI.weekly_price_rows(spark, d), "list_id", lists, ["unit", "no such column"])


@R.register("published_report", R.ORACLE["weekly_cost_report"])
def q_published_report(spark, d):
    rows = SI.weekly_rows(spark, d)
    report = RP.weekly_cost_report(rows, n=R.REPORT_WEEKS)
    header = RP.report_header(rows, value="cost", n=R.REPORT_WEEKS)
    path = target(spark, "report")
    for _ in range(2):  # a rerun replaces the report
        PB.publish_report(report, header, path, "costs", "Costs", R.REPORT_WEEKS)
    return spark.read.parquet(f"{path}/rows").where("report_id = 'costs'").select(*report.columns)


@R.register("published_competitor_matrix", R.ORACLE["competitor_matrix"])
def q_published_competitor_matrix(spark, d):
    # the rows of the last week are found once, for the matrix, its columns and their spans
    rows = land(last_n_periods(SI.competitor_rows(spark, d), "week", 1), "competitor-rows")
    matrix = C.matrix_long(rows, R.CLUSTER_ORDER, n_weeks=None)
    columns = C.columns_with_dates(rows, SI.competitor_fact_rows(spark, d), R.CLUSTER_ORDER, n_weeks=None)
    spans = C.header_spans(C.competitor_columns(rows, R.CLUSTER_ORDER))
    path = target(spark, "matrix")
    PB.publish_competitor_matrix(matrix, columns, spans, path, "competitors")
    return spark.read.parquet(f"{path}/matrix").select(*matrix.columns)


@R.register("rewritten_exports", f"""{R._CLUSTER},{R._SAL}{R.O.sales_export_ctes(R.LIST_CODES, EX.SALES_DATE_TEXT)}
SELECT cluster, category, codigo, precio FROM sal_export WHERE category <> 'Dira'
""")
def q_rewritten_exports(spark, d):
    out = land(EX.sales_export(R._cluster_cells(spark, d), R.LIST_CODES), "sales-export")  # written twice
    path = target(spark, "exports")
    EX.write_exports(out, path, ["cluster", "category"], R.PROCESS_DATE)
    # the group Dira is empty in the rerun: nothing of it stays
    EX.write_exports(out.where("category <> 'Dira'"), path, ["cluster", "category"], R.PROCESS_DATE)
    return spark.read.parquet(path).select("cluster", "category", "codigo", "precio")


@R.register("sales_file_manifest", R.ORACLE["export_manifest"])
def q_sales_file_manifest(spark, d):
    path = target(spark, "sales")
    EX.write_sales_files(EX.sales_export(R._cluster_cells(spark, d), R.LIST_CODES), path, R.PROCESS_DATE)
    return EX.written_manifest(spark, path, R.PROCESS_DATE)


_PRICE_TEXT = r"regexp_replace(CASE WHEN abs(precio) < 1e7 THEN CAST(precio AS VARCHAR) ELSE CAST(CAST(precio AS DECIMAL(38, 6)) AS VARCHAR) END, '\.0*$', '')"


@R.register("sales_file_lines", f"""{R._CLUSTER},{R._SAL}{R.O.sales_export_ctes(R.LIST_CODES, EX.SALES_DATE_TEXT)},
f AS (SELECT cluster, category, 0 AS line, max(nullif(list_code, '')) AS a, NULL AS b, NULL AS c, NULL AS d FROM sal_export GROUP BY 1, 2
      UNION ALL
      SELECT cluster, category, row_number() OVER (PARTITION BY cluster, category ORDER BY workbook, sheet, block_start, row_idx),
             codigo, {_PRICE_TEXT}, '0.00', fecha_texto FROM sal_export)
SELECT cluster, category, CAST(line AS BIGINT) AS line, a, b, c, d FROM f
""")
def q_sales_file_lines(spark, d):
    path = target(spark, "sales-lines")
    EX.write_sales_files(EX.sales_export(R._cluster_cells(spark, d), R.LIST_CODES), path, R.PROCESS_DATE)
    return EX.written_lines(spark, path, R.PROCESS_DATE)


def _history_table(spark, table) -> str:
    path = target(spark, "history")
    V.commit(table, path, ["id_lista"])
    return path


@R.register("written_upsert", R.ORACLE["merge_upsert"])
def q_written_upsert(spark, d):
    table, source = SI.merge_target_source(spark, d)
    path, source = _history_table(spark, table), land(source, "history-source")
    for _ in range(2):  # a rerun gives the same state
        M.write_upsert(spark, path, source, M.HISTORY_KEYS, M.HISTORY_UPDATE_COLS, "seq")
    return V.read_table_version(spark, path)


@R.register("written_upsert_counts", f"""
SELECT rows_total, rows_inserted, rows_updated FROM ({R.ORACLE["merge_stats"]}) WHERE mode = 'upsert'
""")
def q_written_upsert_counts(spark, d):
    """Counts of the load, taken by the job that wrote it."""
    table, source = SI.merge_target_source(spark, d)
    source = land(source, "history-source")
    v = M.write_upsert(spark, _history_table(spark, table), source, M.HISTORY_KEYS, M.HISTORY_UPDATE_COLS, "seq")
    names = ("rows_total", "rows_inserted", "rows_updated")
    return spark.createDataFrame([tuple(v.metrics[n] for n in names)], ", ".join(f"{n} long" for n in names))


@R.register("written_inserts", R.ORACLE["merge_insert_only"])
def q_written_inserts(spark, d):
    table, source = SI.merge_target_source(spark, d)
    path, source = _history_table(spark, table), land(source, "history-source")
    for _ in range(2):  # a rerun inserts nothing
        M.write_insert_only(spark, path, source, M.HISTORY_KEYS, "seq")
    return V.read_table_version(spark, path)


@R.register("written_week_slice", R.ORACLE["replace_week_slice"])
def q_written_week_slice(spark, d):
    """The competitor fact as a table in versions, its current week replaced by a template load."""
    path = target(spark, "competitors")
    fact = keep_last(SI.competitor_fact_rows(spark, d, by_article=True), M.COMPETITOR_KEYS, ["precio", "fecha_modificacion"], "seq")
    # rows of a week meet before the write: a few files each, not one per task and week
    V.commit(fact.select(*M.COMPETITOR_COLUMNS).repartition(*M.COMPETITOR_SLICE), path, M.COMPETITOR_SLICE)
    # the load is made once, for its emptiness test and two writes
    new = land(LD.template_load(R._template_rows(spark, d), R.GS.TEMPLATE_SHEETS, SI.TEMPLATE_AS_OF), "template-load")
    for _ in range(2):  # a rerun replaces the slice by itself
        M.write_slices(new, path, M.COMPETITOR_SLICE, LD.template_slices(SI.TEMPLATE_AS_OF))
    return V.read_table_version(spark, path)


@R.register("weekly_refresh", f"""
SELECT 'price_fact' AS step, 'OK' AS status, count(*) AS n_rows FROM ({R.ORACLE["weekly_price_fact"]})
UNION ALL SELECT 'cost_fact', 'OK', count(*) FROM ({R.ORACLE["weekly_cost_fact"]})
""")
def q_weekly_refresh(spark, d):
    path = target(spark, "refresh")
    WK.refresh_weekly(spark, SI.history_rows(spark, d).drop("_shipdate"), SI.weekly_rows(spark, d), path)
    log = spark.read.parquet(f"{path}/run_log").select("step", "status")
    facts = [spark.read.parquet(f"{path}/{f}").agg(F.lit(f).alias("step"), F.count(F.lit(1)).alias("n_rows"))
             for f in ("price_fact", "cost_fact")]
    return log.join(facts[0].union(facts[1]), "step")


# Rows of weeks from this one on come as a second load
LATE_WEEK = "1998-06-01"


def _refreshed(spark, name, rows, fact):
    """A weekly fact made from a first load, and brought up to date after a late one."""
    path = target(spark, name)
    late = F.coalesce(F.col("week") >= F.lit(LATE_WEEK).cast("date"), F.lit(False))
    for load_id, part in (("first", ~late), ("late", late), ("late", late)):  # a load that comes again adds nothing
        WK.append_load(rows.where(part), f"{path}/history", load_id)
        WK.refresh_changed(spark, f"{path}/history", f"{path}/fact", fact)
    return V.read_table_version(spark, f"{path}/fact")


@R.register("changed_weeks_price_fact", R.ORACLE["weekly_price_fact"])
def q_changed_weeks_price_fact(spark, d):
    rows = SI.history_rows(spark, d).select("id_lista", "cod_art", "fecha", "precio", "seq", week_start("fecha").alias("week"))
    return _refreshed(spark, "price-fact", rows, WK.weekly_price_fact)


@R.register("changed_weeks_cost_fact", R.ORACLE["weekly_cost_fact"])
def q_changed_weeks_cost_fact(spark, d):
    rows = SI.weekly_rows(spark, d).select("article", "week", "cost", "commercial_cost", "seq")
    return _refreshed(spark, "cost-fact", rows, WK.weekly_cost_fact)


@R.register("last_n_weeks_by_manifest", R.ORACLE["last_n_weeks_cost"])
def q_last_n_weeks_by_manifest(spark, d):
    """The newest weeks of a fact by week, found without a scan; only their folders are read."""
    path = target(spark, "weekly-rows")
    V.commit(WK.by_week(SI.weekly_rows(spark, d).drop("seq", "commercial_cost")), path, ["week"])
    return last_n_of_table(spark, path, "week", R.REPORT_WEEKS).select(
        "article", "description", "category", "article_type", "unit", "week", "cost")


def _history_outcomes(spark, d) -> str:
    path = target(spark, "history-outcomes")
    LD.write_history(R._history_cells(spark, d), SI.price_lists(spark, d), path)
    return path


@R.register("written_history_load", R.ORACLE["unpivot_price_history"])
def q_written_history_load(spark, d):
    return LD.written_load(spark, _history_outcomes(spark, d)).drop("seq")


@R.register("written_history_rejects", R.ORACLE["split_rejects"])
def q_written_history_rejects(spark, d):
    return LD.written_rejects(spark, _history_outcomes(spark, d))


_WIDTH = 16
_WIDE = ", ".join(f"max(CASE WHEN col_pos % {_WIDTH} = {i} THEN price END) AS c{i}" for i in range(_WIDTH))


@R.register("competitor_matrix_wide", f"""
SELECT cod_art, description, category, article_type, CAST(col_pos // {_WIDTH} AS INTEGER) AS col_group, {_WIDE}
FROM ({R.ORACLE["competitor_matrix"]}) GROUP BY 1, 2, 3, 4, 5
""")
def q_competitor_matrix_wide(spark, d):
    return C.matrix_wide(R.QUERIES["competitor_matrix"](spark, d), _WIDTH)
