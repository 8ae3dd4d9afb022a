"""The registered queries: name → (spark, sf_dir) -> DataFrame, and the oracle
SQL for each. Every query reads whole tables of ``sf_dir`` (stand-in inputs
derived by Spark from them) and runs the engine's plan over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.operators.periods import keep_first, last_n_periods
from shelfprice.operators.quality import profile
from shelfprice.plans import oracle as O
from shelfprice.plans.reports import (period_long, price_list_report, weekly_commercial_report,
                                      weekly_cost_report)
from shelfprice.sources import standins as SI
from shelfprice.sources import standins_sql as S

REPORT_WEEKS = 8   # report width used by the registered report queries

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------- weekly reports

@register("last_n_weeks_cost", f"""{S.with_ctes(S.WEEKLY_ROWS)}
SELECT article, description, category, article_type, unit, week, cost
FROM weekly_rows
WHERE week IN (SELECT DISTINCT week FROM weekly_rows WHERE week IS NOT NULL
               ORDER BY week DESC LIMIT {REPORT_WEEKS})
""")
def q_last_n_weeks_cost(spark, d):
    rows = SI.weekly_rows(spark, d)
    return last_n_periods(rows, "week", REPORT_WEEKS).select(
        "article", "description", "category", "article_type", "unit", "week", "cost")


@register("article_master", f"""{S.with_ctes(S.WEEKLY_ROWS)}
SELECT article, description, category, article_type, unit FROM (
  SELECT *, row_number() OVER (PARTITION BY article ORDER BY {S.SEQ_ORDER}) AS rn
  FROM weekly_rows) WHERE rn = 1
""")
def q_article_master(spark, d):
    rows = SI.weekly_rows(spark, d)
    return keep_first(rows, ["article"], ["description", "category", "article_type", "unit"], "seq")


@register("weekly_cost_long", O.long_sql([S.WEEKLY_ROWS], "weekly_rows", "cost", REPORT_WEEKS))
def q_weekly_cost_long(spark, d):
    return period_long(SI.weekly_rows(spark, d), value="cost", n=REPORT_WEEKS)


@register("weekly_cost_history", O.long_sql([S.WEEKLY_ROWS], "weekly_rows", "cost", None))
def q_weekly_cost_history(spark, d):
    return period_long(SI.weekly_rows(spark, d), value="cost", n=None)


@register("weekly_cost_report", O.report_sql([S.WEEKLY_ROWS], "weekly_rows", "cost", REPORT_WEEKS))
def q_weekly_cost_report(spark, d):
    return weekly_cost_report(SI.weekly_rows(spark, d), n=REPORT_WEEKS)


@register("weekly_commercial_report",
          O.report_sql([S.WEEKLY_ROWS], "weekly_rows", "commercial_cost", REPORT_WEEKS,
                       row_keys=("article", "description")))
def q_weekly_commercial_report(spark, d):
    return weekly_commercial_report(SI.weekly_rows(spark, d), n=REPORT_WEEKS)


@register("price_list_report",
          O.report_sql([S.PRICE_LISTS, S.LINE_CUSTOMER, S.WEEKLY_PRICE_ROWS], "weekly_price_rows",
                       "price", REPORT_WEEKS, by=("list_id",), unit_flag="text"))
def q_price_list_report(spark, d):
    return price_list_report(SI.weekly_price_rows(spark, d), n=REPORT_WEEKS)


@register("profile_counts", f"""{S.with_ctes(S.WEEKLY_ROWS)}
SELECT count(*) AS n_rows, count(DISTINCT article) AS n_distinct FROM weekly_rows
""")
def q_profile_counts(spark, d):
    return profile(SI.weekly_rows(spark, d), "article")


# ------------------------------------------------------------ competitor matrix

from shelfprice.plans import competitors as C  # noqa: E402

# Custom cluster order of the stand-in (a parameter; unlisted clusters rank 999)
CLUSTER_ORDER = ("EUROPE", "ASIA", "AMERICA")
_ORDER_VALUES = ", ".join(f"('{c}', {i})" for i, c in enumerate(CLUSTER_ORDER))
_COMP_COLS = f"""
latest AS (SELECT * FROM competitor_rows
           WHERE week IN (SELECT DISTINCT week FROM competitor_rows WHERE week IS NOT NULL
                          ORDER BY week DESC LIMIT 1)),
ord(cluster, rnk) AS (VALUES {_ORDER_VALUES}),
cols AS (
  SELECT cluster, competitor, CAST(COALESCE(rnk, 999) AS INTEGER) AS cluster_rank,
         CAST(row_number() OVER (ORDER BY COALESCE(rnk, 999), cluster, competitor) - 1 AS INTEGER) AS col_pos
  FROM (SELECT DISTINCT cluster, competitor FROM latest
        WHERE cluster IS NOT NULL AND competitor IS NOT NULL) LEFT JOIN ord USING (cluster)
)"""


@register("competitor_matrix", f"""{S.with_ctes(S.LINE_CUSTOMER, S.COMPETITOR_ROWS)},{_COMP_COLS},
first_row AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cod_art ORDER BY {S.SEQ_ORDER}) AS rn
                             FROM latest) WHERE rn = 1),
cells AS (SELECT cod_art, cluster, competitor, price FROM (
            SELECT *, row_number() OVER (PARTITION BY cod_art, cluster, competitor ORDER BY {S.SEQ_ORDER}) AS rn
            FROM latest WHERE price IS NOT NULL AND cod_art IS NOT NULL
              AND cluster IS NOT NULL AND competitor IS NOT NULL) WHERE rn = 1)
SELECT c.cod_art, f.description, f.category, f.article_type, c.cluster, c.competitor,
       cols.cluster_rank, cols.col_pos, c.price
FROM cells c JOIN cols USING (cluster, competitor) JOIN first_row f USING (cod_art)
""")
def q_competitor_matrix(spark, d):
    return C.matrix_long(SI.competitor_rows(spark, d), CLUSTER_ORDER, n_weeks=1)


@register("competitor_columns", f"""{S.with_ctes(S.LINE_CUSTOMER, S.COMPETITOR_ROWS, S.COMPETITOR_FACT_ROWS)},{_COMP_COLS},
dates AS (SELECT cluster, trim(competencia) AS competitor, max(fecha_modificacion) AS modified_on
          FROM competitor_fact_rows WHERE fecha_modificacion IS NOT NULL GROUP BY 1, 2)
SELECT cols.cluster, cols.competitor, cols.cluster_rank, cols.col_pos, dates.modified_on,
       strftime(dates.modified_on, '%d/%m/%Y') AS modified_text
FROM cols LEFT JOIN dates ON cols.cluster = dates.cluster AND trim(cols.competitor) = dates.competitor
""")
def q_competitor_columns(spark, d):
    return C.columns_with_dates(SI.competitor_rows(spark, d), SI.competitor_fact_rows(spark, d),
                                CLUSTER_ORDER, n_weeks=1)


@register("competitor_spans", f"""{S.with_ctes(S.LINE_CUSTOMER, S.COMPETITOR_ROWS)},{_COMP_COLS}
SELECT cluster, cluster_rank, min(col_pos) AS first_pos, max(col_pos) AS last_pos,
       count(*) AS n_columns
FROM cols GROUP BY cluster, cluster_rank
""")
def q_competitor_spans(spark, d):
    rows = last_n_periods(SI.competitor_rows(spark, d), "week", 1)
    return C.header_spans(C.competitor_columns(rows, CLUSTER_ORDER))


# ------------------------------------------------------------ scalar cleaning

from shelfprice.functions import dates as FD  # noqa: E402
from shelfprice.functions import text as FT  # noqa: E402


@register("clean_price_text", f"""{S.with_ctes(S.PRICE_TEXT_ROWS)}
SELECT l_orderkey, l_linenumber, price_text, {O.clean_price('price_text')} AS precio
FROM price_text_rows
""")
def q_clean_price_text(spark, d):
    t = SI.price_text_rows(spark, d).select("l_orderkey", "l_linenumber", "price_text")
    return FT.with_clean_price(t, "price_text", "precio")


@register("clean_ratio", f"""{S.with_ctes(S.RATIO_TEXT_ROWS)}
SELECT l_orderkey, l_linenumber, ratio_text, {O.normalise_ratio('ratio_text')} AS ratio
FROM ratio_text_rows
""")
def q_clean_ratio(spark, d):
    t = SI.ratio_text_rows(spark, d)
    return t.select("l_orderkey", "l_linenumber", "ratio_text",
                    FT.normalise_ratio("ratio_text").alias("ratio"))


@register("clean_keys", f"""{S.with_ctes(S.KEY_TEXT_ROWS)}
SELECT p_partkey, key_text, code_text,
       {O.norm_key('key_text')} AS key_norm,
       {O.safe_name(O.strip_cluster('key_text'))} AS file_name,
       {O.strip_cluster('key_text', upper=True)} AS cluster_upper,
       {O.clean_str('key_text')} AS key_clean,
       {O.blank_to_null('key_text')} AS key_or_null,
       {O.code_or_zero('code_text')} AS code,
       {O.code_or_null('code_text')} AS code_checked
FROM key_text_rows
""")
def q_clean_keys(spark, d):
    t = SI.key_text_rows(spark, d)
    return t.select(
        "p_partkey", "key_text", "code_text",
        FT.norm_key("key_text").alias("key_norm"),
        FT.safe_name(FT.strip_cluster_word("key_text")).alias("file_name"),
        FT.strip_cluster_word("key_text", upper=True).alias("cluster_upper"),
        FT.clean_str("key_text").alias("key_clean"),
        FT.blank_to_null("key_text").alias("key_or_null"),
        FT.code_or_zero("code_text").alias("code"),
        FT.code_or_null("code_text").alias("code_checked"))


@register("clean_dates", f"""{S.with_ctes(S.DATE_TEXT_ROWS)},
p AS (SELECT o_orderkey, date_text, {O.parse_dayfirst('date_text')} AS ts FROM date_text_rows)
SELECT o_orderkey, date_text, ts, date_trunc('minute', ts) AS ts_minute,
       CAST(year(ts) AS INTEGER) AS anio, CAST(weekofyear(ts) AS INTEGER) AS semana,
       CAST(isoyear(ts) AS INTEGER) AS iso_anio,
       lower(strftime(ts, '%d-%b')) AS week_label, strftime(ts, '%d/%m/%Y') AS date_out
FROM p
""")
def q_clean_dates(spark, d):
    t = SI.date_text_rows(spark, d).withColumn("ts", FD.parse_dayfirst("date_text"))
    anio, semana = FD.calendar_year_iso_week("ts")
    iso_anio, _ = FD.calendar_year_iso_week("ts", iso_year=True)
    return t.select("o_orderkey", "date_text", "ts", FD.floor_minute("ts").alias("ts_minute"),
                    anio.alias("anio"), semana.alias("semana"), iso_anio.alias("iso_anio"),
                    FD.week_label("ts").alias("week_label"), FD.date_text("ts").alias("date_out"))


@register("split_list_cell", f"""{S.with_ctes(S.LIST_TEXT_ROWS)},
a AS (SELECT c_custkey,
             list_filter(list_transform(string_split_regex({O.clean_str('list_text')}, '[;,]'),
                                        lambda x: trim(x)), lambda x: x <> '') AS arr
      FROM list_text_rows)
SELECT c_custkey, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS item FROM a
""")
def q_split_list_cell(spark, d):
    t = SI.list_text_rows(spark, d)
    return t.select("c_custkey", F.posexplode(FT.split_list("list_text")).alias("pos", "item"))


# ------------------------------------------------------------ loads and merges

from shelfprice.operators import merge as M  # noqa: E402
from shelfprice.operators.periods import keep_last  # noqa: E402
from shelfprice.plans import weekly as WK  # noqa: E402

_HIST_COLS = ", ".join(M.HISTORY_COLUMNS)
_HIST_KEYS = ", ".join(M.HISTORY_KEYS)
_MERGE_CTES = f"""{S.with_ctes(S.PRICE_LISTS, S.LINE_CUSTOMER, S.HISTORY_ROWS)},
tgt AS (SELECT {_HIST_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY {_HIST_KEYS} ORDER BY {S.SEQ_ORDER}) AS rn
          FROM history_rows WHERE l_shipdate < TIMESTAMP '{SI.MERGE_CUTOFF}') WHERE rn = 1),
src AS (SELECT * FROM history_rows
        WHERE l_shipdate >= TIMESTAMP '{SI.MERGE_CUTOFF}' - INTERVAL {SI.MERGE_OVERLAP_DAYS} DAY),
src_first AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY {_HIST_KEYS} ORDER BY {S.SEQ_ORDER}) AS rn
          FROM src) WHERE rn = 1),
src_last AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY {_HIST_KEYS} ORDER BY {S.SEQ_ORDER.replace(',', ' DESC,')} DESC) AS rn
          FROM src) WHERE rn = 1),
src_n AS (SELECT {_HIST_KEYS}, count(*) AS n FROM src GROUP BY {_HIST_KEYS}),
hit AS (SELECT n.*, EXISTS (SELECT 1 FROM tgt t WHERE t.id_lista = n.id_lista AND t.cod_art = n.cod_art
                              AND t.fecha = n.fecha) AS in_t FROM src_n n)"""


@register("dedup_keep_last", f"""{S.with_ctes(S.LINE_CUSTOMER, S.COMPETITOR_ROWS, S.COMPETITOR_FACT_ROWS)}
SELECT {', '.join(M.COMPETITOR_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(M.COMPETITOR_KEYS)}
                               ORDER BY {S.SEQ_ORDER.replace(',', ' DESC,')} DESC) AS rn
  FROM competitor_fact_rows) WHERE rn = 1
""")
def q_dedup_keep_last(spark, d):
    rows = SI.competitor_fact_rows(spark, d, by_article=True)
    return keep_last(rows, M.COMPETITOR_KEYS, ["precio", "fecha_modificacion"], "seq").select(
        *M.COMPETITOR_COLUMNS)


@register("merge_insert_only", f"""{_MERGE_CTES}
SELECT * FROM tgt
UNION ALL
SELECT {_HIST_COLS} FROM src_first s
WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.id_lista = s.id_lista AND t.cod_art = s.cod_art
                  AND t.fecha = s.fecha)
""")
def q_merge_insert_only(spark, d):
    target, source = SI.merge_target_source(spark, d)
    return M.merge_insert_only(target, source, M.HISTORY_KEYS, "seq")


def _upsert_select() -> str:
    out = []
    for c in M.HISTORY_COLUMNS:
        if c in M.HISTORY_KEYS:
            out.append(c)
        elif c in M.HISTORY_UPDATE_COLS:
            out.append(f"CASE WHEN s.in_s THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN t.in_t THEN t.{c} ELSE s.{c} END AS {c}")
    return ", ".join(out)


@register("merge_upsert", f"""{_MERGE_CTES},
s AS (SELECT f.id_lista, f.cod_art, f.fecha, f.origen, f.lista, f.product_id, f.producto, f.uom,
             f.unidad_me, f.invoicing_type, f.contenido, f.box_kgs,
             l.precio, l.precioxkg, l.ing_hora, true AS in_s
      FROM src_first f JOIN src_last l USING ({_HIST_KEYS})),
t AS (SELECT *, true AS in_t FROM tgt)
SELECT {_upsert_select()}
FROM t FULL OUTER JOIN s USING ({_HIST_KEYS})
""")
def q_merge_upsert(spark, d):
    target, source = SI.merge_target_source(spark, d)
    return M.merge_upsert(target, source, M.HISTORY_KEYS, M.HISTORY_UPDATE_COLS, "seq")


@register("merge_stats", f"""{_MERGE_CTES}
SELECT 'upsert' AS mode, CAST(sum(n) AS BIGINT) AS rows_total,
       CAST(sum(CASE WHEN in_t THEN 0 ELSE 1 END) AS BIGINT) AS rows_inserted,
       CAST(sum(n - CASE WHEN in_t THEN 0 ELSE 1 END) AS BIGINT) AS rows_updated,
       CAST(0 AS BIGINT) AS rows_skipped
FROM hit
UNION ALL
SELECT 'insert_only', CAST(sum(n) AS BIGINT), CAST(sum(CASE WHEN in_t THEN 0 ELSE 1 END) AS BIGINT),
       CAST(0 AS BIGINT), CAST(sum(n - CASE WHEN in_t THEN 0 ELSE 1 END) AS BIGINT)
FROM hit
""")
def q_merge_stats(spark, d):
    target, source = SI.merge_target_source(spark, d)
    return M.merge_stats(target, source, M.HISTORY_KEYS)


@register("weekly_price_fact", f"""{S.with_ctes(S.PRICE_LISTS, S.LINE_CUSTOMER, S.HISTORY_ROWS)}
SELECT id_lista, cod_art, week, precio, fecha AS last_fecha, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT *, CAST(date_trunc('week', fecha) AS DATE) AS week,
         row_number() OVER (PARTITION BY id_lista, cod_art, date_trunc('week', fecha)
                            ORDER BY fecha DESC, {S.SEQ_ORDER.replace(',', ' DESC,')} DESC) AS rn,
         count(*) OVER (PARTITION BY id_lista, cod_art, date_trunc('week', fecha)) AS n_rows
  FROM history_rows WHERE fecha IS NOT NULL) WHERE rn = 1
""")
def q_weekly_price_fact(spark, d):
    return WK.weekly_price_fact(SI.history_rows(spark, d).drop("_shipdate"))


@register("weekly_cost_fact", f"""{S.with_ctes(S.WEEKLY_ROWS)}
SELECT article, week, cost, commercial_cost, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY article, week
                               ORDER BY {S.SEQ_ORDER.replace(',', ' DESC,')} DESC) AS rn,
         count(*) OVER (PARTITION BY article, week) AS n_rows
  FROM weekly_rows WHERE week IS NOT NULL AND article IS NOT NULL) WHERE rn = 1
""")
def q_weekly_cost_fact(spark, d):
    return WK.weekly_cost_fact(SI.weekly_rows(spark, d))


# ------------------------------------------------------------ spreadsheet grids

from shelfprice.operators.grid import cells_from_rows, detect_blocks, last_columns_rows  # noqa: E402
from shelfprice.plans import exports as EX  # noqa: E402
from shelfprice.plans import loads as LD  # noqa: E402
from shelfprice.sources import grid_standins as GS  # noqa: E402
from shelfprice.sources import grid_standins_sql as GQ  # noqa: E402
from shelfprice.session import land  # noqa: E402


def _cluster_cells(spark, d):
    """The derived cluster sheets as sheet rows; a landing table where the session has a
    shared folder, else derived within the plan."""
    return land(GS.cluster_sheet_rows(spark, d), "cluster-rows")


def _history_cells(spark, d):
    return land(GS.history_sheet_cells(spark, d), "history-cells")


def _template_rows(spark, d):
    return GS.template_rows(spark, d)  # landed by itself


# stand-in parameters: list code per cluster (cluster name without the word CLUSTER)
LIST_CODES = {"ALFA": "L-01", "BETA": "L-02", "DELTA": "L-04"}
PROCESS_DATE = "2024-06-03"
_CLUSTER = S.with_ctes(GQ.CLUSTER_CELLS)
_PUB = O.block_records_ctes("cluster_cells", EX.PUBLICATION_ALIASES, False, "pub_")
_SAL = O.block_records_ctes("cluster_cells", EX.SALES_ALIASES, True, "sal_")
_PUB_FIELDS = list(EX.PUBLICATION_ALIASES)


@register("detect_blocks", f"""{_CLUSTER},{_PUB}
SELECT workbook, sheet, block_start, block_end, block_name FROM pub_blocks
""")
def q_detect_blocks(spark, d):
    rows = _cluster_cells(spark, d)
    # block names sit on the name row: only that row is exploded to cells
    names = cells_from_rows(rows.where(F.col("row_idx") == 1))
    return detect_blocks(names, 1, last_col=last_columns_rows(rows))


@register("block_records", f"""{_CLUSTER},{_PUB}
SELECT workbook, sheet, block_start, block_name, row_idx, {', '.join(_PUB_FIELDS)},
       {', '.join('has_' + f for f in _PUB_FIELDS)}
FROM pub_rec
""")
def q_block_records(spark, d):
    return EX.publication_records(_cluster_cells(spark, d))


@register("publication_export", f"""{_CLUSTER},{_PUB}{O.publication_export_sql()}
""")
def q_publication_export(spark, d):
    return EX.publication_export(_cluster_cells(spark, d))


@register("sales_export", f"""{_CLUSTER},{_SAL}{O.sales_export_ctes(LIST_CODES, EX.SALES_DATE_TEXT)}
SELECT * FROM sal_export
""")
def q_sales_export(spark, d):
    return EX.sales_export(_cluster_cells(spark, d), LIST_CODES)


@register("export_manifest", f"""{_CLUSTER},{_SAL}{O.sales_export_ctes(LIST_CODES, EX.SALES_DATE_TEXT)}
SELECT cluster, category, count(*) AS n_rows, DATE '{PROCESS_DATE}' AS process_date
FROM sal_export GROUP BY cluster, category
""")
def q_export_manifest(spark, d):
    out = EX.sales_export(_cluster_cells(spark, d), LIST_CODES)
    return EX.export_manifest(out, ["cluster", "category"], PROCESS_DATE)


_HIST = f"{S.with_ctes(S.PRICE_LISTS, S.LINE_CUSTOMER, GQ.HISTORY_CELLS)}{O.history_parsed_ctes()}"


@register("unpivot_price_history", f"""{_HIST}
SELECT 'excel' AS origen, l.list_id AS id_lista, t.sheet AS lista, t._fecha AS fecha,
       0 AS product_id, {O.code_or_zero('t._code')} AS cod_art, COALESCE(t.producto, '') AS producto,
       t._precio AS precio, '' AS uom, '' AS unidad_me, '' AS invoicing_type,
       CAST(0.0 AS DOUBLE) AS contenido, CAST(0.0 AS DOUBLE) AS box_kgs, CAST(0.0 AS DOUBLE) AS precioxkg,
       t._fecha AS ing_hora
FROM hp_tagged t JOIN price_lists l ON l.list_name = t.sheet
WHERE t.reject_reason IS NULL
""")
def q_unpivot_price_history(spark, d):
    cells = _history_cells(spark, d)
    return LD.history_load(cells, SI.price_lists(spark, d)).drop("seq")


@register("unpivot_price_history_rows", ORACLE["unpivot_price_history"])
def q_unpivot_price_history_rows(spark, d):
    """The same sheets as sheet rows."""
    rows = land(GS.history_sheet_rows(spark, d), "history-rows")
    return LD.history_load(rows, SI.price_lists(spark, d)).drop("seq")


@register("split_rejects", f"""{_HIST}
SELECT t.workbook, t.sheet, row_idx, col_idx, price_value, date_value,
       CASE WHEN reject_reason IS NOT NULL THEN reject_reason WHEN l.list_id IS NULL THEN 'unknown_list'
            ELSE 'bad_code' END AS reject_reason,
       reject_reason IS NULL AND l.list_id IS NOT NULL AS loaded
FROM hp_tagged t LEFT JOIN price_lists l ON l.list_name = t.sheet
WHERE reject_reason IS NOT NULL OR l.list_id IS NULL
   OR (t._code IS NOT NULL AND {O.code_or_null('t._code')} IS NULL)
""")
def q_split_rejects(spark, d):
    return LD.history_rejects(_history_cells(spark, d), SI.price_lists(spark, d))


_TPL = (f"{S.with_ctes(S.LINE_CUSTOMER, GQ.TEMPLATE_CELLS)}"
        f"{O.template_load_ctes(GS.TEMPLATE_SHEETS, SI.TEMPLATE_AS_OF)}")


@register("melt_competitor_template", f"""{_TPL}
SELECT * FROM tl_final
""")
def q_melt_competitor_template(spark, d):
    return LD.template_load(_template_rows(spark, d), GS.TEMPLATE_SHEETS, SI.TEMPLATE_AS_OF)


@register("replace_week_slice", f"""{_TPL}, {S.COMPETITOR_ROWS}, {S.COMPETITOR_FACT_ROWS},
existing AS (
  SELECT {', '.join(M.COMPETITOR_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY {', '.join(M.COMPETITOR_KEYS)}
                                 ORDER BY {S.SEQ_ORDER.replace(',', ' DESC,')} DESC) AS rn
    FROM competitor_fact_rows) WHERE rn = 1)
SELECT * FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM tl_final f WHERE f.anio = e.anio AND f.semana = e.semana)
UNION ALL
SELECT * FROM tl_final
""")
def q_replace_week_slice(spark, d):
    existing = keep_last(SI.competitor_fact_rows(spark, d, by_article=True), M.COMPETITOR_KEYS,
                         ["precio", "fecha_modificacion"], "seq").select(*M.COMPETITOR_COLUMNS)
    new = LD.template_load(_template_rows(spark, d), GS.TEMPLATE_SHEETS, SI.TEMPLATE_AS_OF)
    return M.replace_slices(existing, new, LD.template_slices(SI.TEMPLATE_AS_OF))


# the written targets register themselves
from shelfprice.plans import written  # noqa: E402, F401
