"""Stand-in inputs built by Spark from the TPC-H-like test tables.

The engine's real inputs (weekly cost/price results, competitor prices, price
history, spreadsheet grids in cell form) are not part of the test data, so each
is derived from the test tables with a fixed rule (see FIXTURES.md §2). The same
rules are written in SQL in ``shelfprice.sources.standins_sql`` for the oracle.

Every builder reads whole tables; work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.functions.dates import week_start
from shelfprice.functions.text import clean_price_number
from shelfprice.sources.tables import read_table

# total input order of a lineitem row ("seq"); unique on the test data
SEQ_FIELDS = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_quantity", "l_extendedprice", "l_discount")

# fixed cut-off of the merge fixtures: target = before, source = from 4 weeks earlier on
MERGE_CUTOFF = "2000-01-01"
MERGE_OVERLAP_DAYS = 28
# run date of the competitor template load (a Monday; calendar year 2001, ISO week 44)
TEMPLATE_AS_OF = "2001-10-29"


def seq_struct() -> Column:
    return F.struct(*[F.col(c) for c in SEQ_FIELDS])


def _lineitem(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select(*SEQ_FIELDS, "l_tax", "l_returnflag",
                                                   "l_linestatus")


def _part(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                               "p_size", "p_retailprice")


def article_expr() -> Column:
    return F.concat(F.col("p_brand"), F.lit("|"), F.col("p_type"))


def weekly_rows(spark: SparkSession, d: str) -> DataFrame:
    """F1 weekly cost rows: article attributes, week, unit cost, commercial cost."""
    li = _lineitem(spark, d)
    p = _part(spark, d)
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        article_expr().alias("article"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("article_type"),
        F.col("p_size").alias("unit"),
        week_start("l_shipdate").alias("week"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("cost"),
        F.try_divide(F.col("l_extendedprice") * (1 - F.col("l_discount")),
                     F.col("l_quantity")).alias("commercial_cost"),
        seq_struct().alias("seq"),
    )


def price_lists(spark: SparkSession, d: str) -> DataFrame:
    """F8 price-list dimension derived from the data: one list per market
    segment, ids by name order (a handful of rows)."""
    from pyspark.sql import Window
    seg = read_table(spark, d, "customer").select("c_mktsegment").distinct()
    w = Window.orderBy("c_mktsegment")
    return seg.select(F.dense_rank().over(w).cast("int").alias("list_id"),
                      F.col("c_mktsegment").alias("list_name"))


def _line_customer(spark: SparkSession, d: str) -> DataFrame:
    """lineitem rows with the customer's segment and region name."""
    li = _lineitem(spark, d)
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, d, "region").select("r_regionkey", "r_name")
    # the narrow orders meet their customers first: lineitem moves once, by order
    by_order = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return li.join(by_order, F.col("l_orderkey") == F.col("o_orderkey"))


def weekly_price_rows(spark: SparkSession, d: str) -> DataFrame:
    """F2 weekly price rows of every list (list = customer segment)."""
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    lists = price_lists(spark, d)
    j = (lc.join(p, F.col("l_partkey") == F.col("p_partkey"))
           .join(lists, F.col("c_mktsegment") == F.col("list_name")))
    return j.select(
        F.col("list_id"),
        article_expr().alias("article"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("article_type"),
        F.concat(F.col("p_size").cast("string"), F.lit("-"), F.col("p_type")).alias("unit"),
        week_start("l_shipdate").alias("week"),
        F.try_divide(F.col("l_extendedprice") * (1 + F.col("l_tax")),
                     F.col("l_quantity")).alias("price"),
        seq_struct().alias("seq"),
    )


def competitor_rows(spark: SparkSession, d: str, by_article: bool = False) -> DataFrame:
    """F3 competitor weekly prices: cluster = customer region, competitor = supplier. With
    ``by_article`` the rows of an article are in one task, however small the parts are: an
    aggregate by article and more keys needs no exchange of its buffers, which are wider."""
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    if by_article:
        p = p.hint("shuffle_hash")
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    # the part last: aggregates by article take over that join's distribution
    j = (lc.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(p, F.col("l_partkey") == F.col("p_partkey")))
    return j.select(
        F.col("l_partkey").alias("cod_art"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("article_type"),
        F.col("r_name").alias("cluster"),
        F.col("s_name").alias("competitor"),
        week_start("l_shipdate").alias("week"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("o_orderdate").cast("date").alias("modified_on"),
        seq_struct().alias("seq"),
    )


def competitor_fact_rows(spark: SparkSession, d: str, by_article: bool = False) -> DataFrame:
    """F4 rows as loaded week by week (before the keep-last on the row key)."""
    from shelfprice.functions.dates import calendar_year_iso_week
    c = competitor_rows(spark, d, by_article)
    year, week = calendar_year_iso_week(F.col("seq.l_shipdate"))
    return c.select(
        "cod_art", "cluster", F.col("competitor").alias("competencia"),
        clean_price_number(F.col("price")).alias("precio"),
        year.alias("anio"), week.alias("semana"),
        F.col("modified_on").alias("fecha_modificacion"),
        "seq",
    )


def history_rows(spark: SparkSession, d: str) -> DataFrame:
    """F5 price-history rows (one per lineitem) in load order ``seq``."""
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    lists = price_lists(spark, d)
    j = (lc.join(p, F.col("l_partkey") == F.col("p_partkey"))
           .join(lists, F.col("c_mktsegment") == F.col("list_name")))
    fecha = F.date_trunc("minute", F.col("l_shipdate"))
    return j.select(
        F.lit("excel").alias("origen"),
        F.col("list_id").alias("id_lista"),
        F.col("list_name").alias("lista"),
        fecha.alias("fecha"),
        F.lit(0).alias("product_id"),
        F.col("l_partkey").alias("cod_art"),
        F.col("p_name").alias("producto"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("precio"),
        F.lit("").alias("uom"),
        F.lit("").alias("unidad_me"),
        F.lit("").alias("invoicing_type"),
        F.lit(0.0).alias("contenido"),
        F.lit(0.0).alias("box_kgs"),
        F.col("l_discount").alias("precioxkg"),
        (fecha + F.expr("INTERVAL 1 MINUTE") * F.col("l_linenumber")).alias("ing_hora"),
        seq_struct().alias("seq"),
        F.col("l_shipdate").alias("_shipdate"),
    )


def merge_target_source(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Target = rows shipped before the cut-off (first row per key, as an insert-only
    load would leave them); source = rows from 4 weeks before the cut-off on."""
    from shelfprice.operators.merge import HISTORY_KEYS, collapse_insert_only
    rows = history_rows(spark, d)
    cutoff = F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    before = rows.where(F.col("_shipdate") < cutoff).drop("_shipdate")
    target = collapse_insert_only(before, HISTORY_KEYS, "seq").drop("seq")
    source = rows.where(F.col("_shipdate") >= F.date_sub(cutoff, MERGE_OVERLAP_DAYS)
                        .cast("timestamp_ntz")).drop("_shipdate")
    return target, source


# ---------------------------------------------------------------- grid fixtures

def cents_text(cents: Column) -> Column:
    """'1234.05' from a non-negative integer number of cents (same text in every engine)."""
    c = cents.cast("bigint")
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."),
                    F.lpad((c % 100).cast("string"), 2, "0"))


def thousands_text(cents: Column) -> Column:
    """'$ 1.234,05': dot thousands separator and decimal comma (values < 1e9)."""
    units = F.floor(cents.cast("bigint") / 100)
    frac = F.lpad((cents.cast("bigint") % 100).cast("string"), 2, "0")
    thousands = F.floor(units / 1000)
    rest = F.lpad((units % 1000).cast("string"), 3, "0")
    int_text = F.when(units >= 1000, F.concat(thousands.cast("string"), F.lit("."), rest)) \
        .otherwise(units.cast("string"))
    return F.concat(F.lit("$ "), int_text, F.lit(","), frac)


def price_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """Price text in several layouts, chosen by the line number (FN3 input)."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                                 "l_extendedprice", "l_returnflag")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    plain = cents_text(cents)
    text = (F.when(F.col("l_linenumber") == 1, plain)
            .when(F.col("l_linenumber") == 2, F.replace(plain, F.lit("."), F.lit(",")))
            .when(F.col("l_linenumber") == 3, thousands_text(cents))
            .when(F.col("l_linenumber") == 4, F.concat(F.lit(" $"), plain, F.lit(" ")))
            .when(F.col("l_linenumber") == 5,
                  F.concat(F.floor(cents / 100000).cast("string"), F.lit("."),
                           F.lpad((F.floor(cents / 100) % 1000).cast("string"), 3, "0")))
            .when(F.col("l_linenumber") == 6,
                  F.when(F.col("l_returnflag") == "R", F.lit("0"))
                  .when(F.col("l_returnflag") == "A", F.lit(""))
                  .otherwise(F.lit("s/p")))
            .otherwise(F.concat(plain, F.lit("e1"))))
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", text.alias("price_text"))


def ratio_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """'vs previous list' text in several layouts (FN5 input)."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    t = F.round(F.col("l_discount") * 1000).cast("bigint")   # tenths of a percent
    whole = F.floor(t / 10).cast("string")
    text = (F.when(F.col("l_linenumber") == 1,
                   F.concat(whole, F.lit(","), (t % 10).cast("string"), F.lit("%")))
            .when(F.col("l_linenumber") == 2, F.concat(F.lit("0."), F.lpad(t.cast("string"), 3, "0")))
            .when(F.col("l_linenumber") == 3, F.concat(F.lit("-"), whole))
            .when(F.col("l_linenumber") == 4, F.lit("abc"))
            .when(F.col("l_linenumber") == 5, F.concat(whole, F.lit(".5%")))
            .when(F.col("l_linenumber") == 6, F.lit("0.5%")))
    return li.select("l_orderkey", "l_linenumber", text.alias("ratio_text"))


def key_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """Names and codes in messy layouts (FN7-FN9, FN14, FN15 input)."""
    p = _part(spark, d)
    key = (F.when(F.col("p_type") == "ECONOMY",
                  F.concat(F.lit("  "), F.upper("p_name"), F.lit("  ")))
           .when(F.col("p_type") == "LARGE",
                 F.concat(F.col("p_name"), F.lit(" / CLUSTER: "), F.col("p_brand")))
           .when(F.col("p_type") == "MEDIUM", F.lit("nan"))
           .when(F.col("p_type") == "PROMO", F.lit(""))
           .when(F.col("p_type") == "STANDARD",
                 F.concat(F.lit("Mayoristas   CLUSTER  "), F.col("p_name"), F.lit("?"))))
    pk = F.col("p_partkey").cast("string")
    code = (F.when(F.col("p_size") <= 10, F.concat(pk, F.lit(".7")))
            .when(F.col("p_size") <= 20, F.concat(F.lit("X"), pk))
            .when(F.col("p_size") <= 30, F.lit(""))
            .when(F.col("p_size") <= 40, F.concat(F.lit(" "), pk, F.lit(" ")))
            .otherwise(pk))
    return p.select("p_partkey", key.alias("key_text"), code.alias("code_text"))


def date_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """Date text: day-first with and without time, ISO, padded, invalid (FN11-13, FN20)."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    ts = F.expr("o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), "
                "CAST(o_orderkey % 60 AS INT), CAST(o_orderkey % 60 AS INT))")
    pr = F.col("o_orderpriority")
    text = (F.when(pr == "1-URGENT", F.date_format("o_orderdate", "d/M/yyyy"))
            .when(pr == "2-HIGH", F.date_format(ts, "d/M/yyyy H:mm"))
            .when(pr == "3-MEDIUM", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(pr == "4-NOT SPECIFIED", F.date_format("o_orderdate", "dd/MM/yyyy"))
            .otherwise(F.concat(F.lit("31/2/"), F.year("o_orderdate").cast("string"))))
    return o.select("o_orderkey", text.alias("date_text"))


def list_text_rows(spark: SparkSession, d: str) -> DataFrame:
    """Multi-valued cells separated by ';' or ',' with blanks (FN10 input)."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    tail = F.when(F.col("c_acctbal") < 0, F.lit(" ")).otherwise(F.lit(" x@y.com "))
    return c.select("c_custkey", F.concat(F.col("c_name"), F.lit("; "), F.col("c_mktsegment"),
                                         F.lit(",,"), tail).alias("list_text"))
