"""Spreadsheet grids in cell form, derived by Spark from the test tables.

* cluster sheet — one sheet per supplier; four cluster blocks side by side with
  different header layouts; one record row per part the supplier sold;
* price-history sheet — one sheet per price list; base columns (rubro, code,
  product), one dated price column every third column (one per month);
* competitor template — one sheet per region; code/description/rubro then one
  column per supplier, dates above the headers, prices below.

The same layouts are written in SQL in ``grid_standins_sql`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.session import land
from shelfprice.sources.standins import _line_customer, _part, cents_text, seq_struct, thousands_text
from shelfprice.sources.tables import read_table

# Fixed layout of the stand-in cluster sheet:
# (col_idx, header_row, header text, value) — the header of column 9 depends on the sheet
CLUSTER_LAYOUT = (
    (1, 3, "Rubro", "rubro"), (2, 3, "Tipo", "tipo"), (3, 3, "Cód.", "cod"),
    (4, 3, "Descripción", "desc"), (5, 3, "sin IVA", "siniva"), (6, 3, "$", "precio"),
    (7, 3, "VS LISTA ANTERIOR", "vs"), (8, 3, "unidad_me", "unidad"),
    (9, 4, None, "rubro"), (10, 4, "Cod", "cod"), (11, 4, "Descripción", "desc"),
    (12, 4, "Sin  Iva", "siniva"), (13, 4, "$", "precio"), (14, 4, "Vs lista anterior", "vs"),
    (15, 2, " RUBRO ", "rubro"), (16, 2, "Código", "cod"), (17, 2, "SIN IVA", "siniva"),
    (18, 2, "Descripción", "desc"),
    (19, 3, "Sub Rubro", "rubro"), (20, 3, "Cód.", "cod"), (21, 3, "sin iva", "siniva"),
    (22, 3, "notas", "notas"),
)
CLUSTER_NAMES = ((1, "CLUSTER ALFA"), (9, "CLUSTER BETA"), (15, "GAMMA"), (19, "DELTA CLUSTER"))
CLUSTER_NAME_ROW = 1
CLUSTER_FIRST_DATA_ROW = 6
# the stand-in template sheets in load order (a missing sheet is skipped)
TEMPLATE_SHEETS = ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "AFRICA", "ANTARCTICA")

_CELL = "struct<col_idx:int,value:string>"


def _cells(base: DataFrame, wb: Column, sheet: Column, row: Column,
           cells: list[tuple[int, Column]]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).cast("int").alias("col_idx"),
                             v.cast("string").alias("value")) for c, v in cells])
    return (base.select(wb.alias("workbook"), sheet.alias("sheet"),
                        row.cast("bigint").alias("row_idx"), F.inline(arr)))


def cluster_sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """Cluster sheets as sheet rows (workbook, sheet, row_idx, values): one sheet
    per supplier, the cluster-name and header rows on top, then one row per part
    the supplier sold. ``values[i]`` is the cell in column i (null when blank)."""
    li = read_table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    p = _part(spark, d)
    base = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(p, F.col("l_partkey") == F.col("p_partkey")))
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    values = {
        "rubro": (F.when(F.col("p_type") == "ECONOMY", "Carnes")
                  .when(F.col("p_type") == "LARGE", "Fiambres")
                  .when(F.col("p_type") == "MEDIUM", "Reventa")
                  .when(F.col("p_type") == "PROMO", "Dira")
                  .when(F.col("p_type") == "SMALL", " carnes ")
                  .otherwise("Otros")),
        "tipo": F.col("p_brand"),
        "cod": F.col("p_partkey").cast("string"),
        "desc": F.col("p_name"),
        "siniva": (F.when(F.col("p_size") == 1, "0").when(F.col("p_size") == 2, "n/d")
                   .when(F.col("p_size") == 3, "0.4").otherwise(cents_text(cents))),
        "precio": cents_text(F.floor(cents * 121 / 100)),
        "vs": F.concat((F.col("p_size") - 25).cast("string"), F.lit(",5%")),
        "unidad": F.col("p_size").cast("string"),
        "notas": F.col("p_type"),
    }
    width = max(c for c, _hr, _h, _k in CLUSTER_LAYOUT) + 1
    data_cells: dict[int, Column] = {}
    for col, _hr, _h, key in CLUSTER_LAYOUT:
        v = values[key]
        if col == 6:
            v = F.when(F.col("p_size") <= 45, v)
        if 15 <= col <= 18:
            v = F.when(F.col("p_size") <= 40, v)
        data_cells[col] = v.cast("string")
    wb = F.lit("clusters")
    data = base.select(wb.alias("workbook"), F.col("s_name").alias("sheet"),
                       (F.col("p_partkey") + CLUSTER_FIRST_DATA_ROW).cast("bigint").alias("row_idx"),
                       _row_array(data_cells, width).alias("values"))
    sheets = s.join(li.select("l_suppkey").distinct(), F.col("l_suppkey") == F.col("s_suppkey"),
                    "left_semi")
    # the cluster-name row and the header rows of every sheet, emitted in one pass
    fixed: dict[int, dict[int, Column]] = {CLUSTER_NAME_ROW: {c: F.lit(n) for c, n in CLUSTER_NAMES}}
    for col, hr, h, _k in CLUSTER_LAYOUT:
        text = F.lit(h) if h is not None else \
            F.when(F.col("s_nationkey") >= 20, F.lit("Grupo")).otherwise(F.lit(" rubro"))
        fixed.setdefault(hr, {})[col] = text
    arr = F.array(*[F.struct(F.lit(r).cast("bigint").alias("row_idx"),
                             _row_array(cells, width).alias("values"))
                    for r, cells in sorted(fixed.items())])
    heads = sheets.select(wb.alias("workbook"), F.col("s_name").alias("sheet"), F.inline(arr))
    return data.unionByName(heads)


def _row_array(cells: dict[int, Column], width: int) -> Column:
    return F.array(*[cells[i] if i in cells else F.lit(None).cast("string") for i in range(width)])


def _month_index(ts: Column) -> Column:
    return ((F.year(ts) - 1995) * 12 + F.month(ts) - 1).cast("int")


def history_sheet_cells(spark: SparkSession, d: str) -> DataFrame:
    """Price-history sheets: one per list (segment); row = 4 + part key; price
    column 3 + 3·month; dates on row 3; base columns 0-2."""
    from shelfprice.sources.standins import price_lists
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    j = lc.join(p, F.col("l_partkey") == F.col("p_partkey"))
    first = (j.groupBy(F.col("c_mktsegment").alias("sheet"), "p_partkey",
                       _month_index(F.col("l_shipdate")).alias("k"))
             .agg(F.min_by(F.struct("l_extendedprice", "l_returnflag", "l_linestatus",
                                    "l_linenumber"), seq_struct()).alias("f"),
                  F.min(F.date_trunc("month", "l_shipdate")).alias("month")))
    cents = F.round(F.col("f.l_extendedprice") * 100).cast("bigint")
    price_text = (F.when((F.col("f.l_returnflag") == "R") & (F.col("f.l_linestatus") == "O"), "s/p")
                  .when(F.col("f.l_linenumber") == 7, "0")
                  .otherwise(cents_text(cents)))
    wb = F.lit("history")
    prices = first.select(wb.alias("workbook"), "sheet",
                          (F.col("p_partkey") + 4).cast("bigint").alias("row_idx"),
                          (F.col("k") * 3 + 3).cast("int").alias("col_idx"),
                          price_text.alias("value"))
    qty = first.select(wb.alias("workbook"), "sheet",
                       (F.col("p_partkey") + 4).cast("bigint").alias("row_idx"),
                       (F.col("k") * 3 + 4).cast("int").alias("col_idx"),
                       F.col("f.l_linenumber").cast("string").alias("value"))
    months = first.select("sheet", "k", "month").distinct()
    date_text = F.when(F.month("month") == 6, F.lit("junio")) \
        .otherwise(F.date_format("month", "d/M/yyyy"))
    dates = months.select(wb.alias("workbook"), "sheet", F.lit(3).cast("bigint").alias("row_idx"),
                          (F.col("k") * 3 + 3).cast("int").alias("col_idx"), date_text.alias("value"))
    rows = first.select("sheet", "p_partkey").distinct().join(p, "p_partkey")
    code = (F.when(F.col("p_size") == 7, F.concat(F.lit("X"), F.col("p_partkey").cast("string")))
            .when(F.col("p_size") == 8, F.lit(""))
            .otherwise(F.col("p_partkey").cast("string")))
    product = F.when((F.col("p_size") == 8) & (F.col("p_brand") == "Brand#1"), F.lit(None)) \
        .otherwise(F.col("p_name"))
    base = _cells(rows, wb, F.col("sheet"), F.col("p_partkey") + 4,
                  [(0, F.col("p_type")), (1, code), (2, product)])
    lists = price_lists(spark, d).select(F.col("list_name").alias("sheet"))
    title = lists.select(wb.alias("workbook"), "sheet", F.lit(0).cast("bigint").alias("row_idx"),
                         F.lit(0).cast("int").alias("col_idx"), F.lit("Lista de precios").alias("value"))
    return (prices.unionByName(qty).unionByName(dates).unionByName(base).unionByName(title)
            .where(F.col("value").isNotNull()))


def history_sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """The sheets of :func:`history_sheet_cells` as sheet rows."""
    from shelfprice.sources.standins import price_lists
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    k = _month_index(F.col("l_shipdate")).alias("k")
    first = (lc.groupBy(F.col("c_mktsegment").alias("sheet"), F.col("l_partkey").alias("p_partkey"), k)
             .agg(F.min_by(F.struct("l_extendedprice", "l_returnflag", "l_linestatus",
                                    "l_linenumber"), seq_struct()).alias("f")))
    cents = F.round(F.col("f.l_extendedprice") * 100).cast("bigint")
    price_text = (F.when((F.col("f.l_returnflag") == "R") & (F.col("f.l_linestatus") == "O"), "s/p")
                  .when(F.col("f.l_linenumber") == 7, "0")
                  .otherwise(cents_text(cents)))
    wb, none = F.lit("history").alias("workbook"), F.lit(None).cast("string")

    def months(values) -> Column:
        """Three cells for each month up to the last one of ``_s``, the row's cells in order;
        months between two of them are blank."""
        def part(v: Column, i: Column) -> Column:
            before = F.when(i > 0, F.try_element_at("_s", i)["k"]).otherwise(F.lit(-1))
            return F.concat(F.array_repeat(none, (v["k"] - before - 1) * 3), values(v))
        return F.flatten(F.transform("_s", part))
    cell = F.struct("k", price_text.alias("price"), F.col("f.l_linenumber").cast("string").alias("n"))
    code = (F.when(F.col("p_size") == 7, F.concat(F.lit("X"), F.col("p_partkey").cast("string")))
            .when(F.col("p_size") == 8, F.lit(""))
            .otherwise(F.col("p_partkey").cast("string")))
    product = F.when((F.col("p_size") == 8) & (F.col("p_brand") == "Brand#1"), F.lit(None)) \
        .otherwise(F.col("p_name"))
    # sorted below the join: above it, they would be sorted anew for every month
    data = (first.groupBy("sheet", "p_partkey")
            .agg(F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), cell))).alias("_s"))
            .join(p, "p_partkey")
            .select(wb, "sheet", (F.col("p_partkey") + 4).cast("bigint").alias("row_idx"),
                    F.concat(F.array(F.col("p_type"), code, product),
                             months(lambda v: F.array(v["price"], v["n"], none))).alias("values")))
    # the date of a month's column: its first day
    day = F.make_date(F.floor(F.col("k") / 12).cast("int") + 1995, F.pmod("k", F.lit(12)) + 1, F.lit(1))
    text = F.when(F.pmod("k", F.lit(12)) == 5, F.lit("junio")).otherwise(F.date_format(day, "d/M/yyyy"))
    dates = (first.where(F.col("k").isNotNull()).select("sheet", "k").distinct()
             .groupBy("sheet").agg(F.sort_array(F.collect_list(F.struct("k", text.alias("v")))).alias("_s"))
             .select(wb, "sheet", F.lit(3).cast("bigint").alias("row_idx"),
                     F.concat(F.array(none, none, none),
                              months(lambda v: F.array(v["v"], none, none))).alias("values")))
    title = price_lists(spark, d).select(wb, F.col("list_name").alias("sheet"), F.lit(0).cast("bigint").alias("row_idx"),
                                         F.array(F.lit("Lista de precios")).alias("values"))
    return data.unionByName(dates).unionByName(title)


NATIONS = 25  # competitor columns of a template sheet: one per supplier nation


def template_rows(spark: SparkSession, d: str) -> DataFrame:
    """Competitor template as sheet rows: sheet per customer region; row = 3 + part key;
    column 3 + nation key of the supplier; dates on row 1, headers on row 2. In ASIA the
    code column is not the first one; in EUROPE the last competitor column has the
    description header, in AFRICA the last but one has none, in AMERICA three have one header.

    The lines of a part meet in one task, by one exchange: its cells, its rows and its
    attributes follow there. The data rows are landed with the dates of their cells, from
    which the top rows are made: lineitem is not joined a second time for them."""
    lc = _line_customer(spark, d)
    p = _part(spark, d)
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    j = lc.join(s, F.col("l_suppkey") == F.col("s_suppkey")).repartition("l_partkey")
    first = (j.groupBy(F.col("r_name").alias("sheet"), F.col("l_partkey").alias("p_partkey"), "s_nationkey")
             .agg(F.min_by(F.struct("l_extendedprice", "l_linenumber"), seq_struct()).alias("f"),
                  F.max("o_orderdate").alias("last_order")))
    cents = F.round(F.col("f.l_extendedprice") * 100).cast("bigint")
    ln = F.col("f.l_linenumber")
    text = (F.when(ln == 2, thousands_text(cents))
            .when(ln == 3, F.replace(cents_text(cents), F.lit("."), F.lit(",")))
            .when(ln == 4, F.lit(None).cast("string"))
            .otherwise(cents_text(cents)))
    wb, asia = F.lit("template").alias("workbook"), F.col("sheet") == "ASIA"

    def values(code: Column, name: Column, kind: Column, cells: str) -> Column:
        # at most one cell per nation
        by = F.col(cells)
        return F.concat(F.when(asia, F.array(kind, code, name)).otherwise(F.array(code, name, kind)),
                        F.transform(F.sequence(F.lit(0), F.lit(NATIONS - 1)), lambda k: F.try_element_at(by, k)))
    # the maps are made by the aggregates: above, they would be made anew for every column
    cell = F.map_from_entries(F.collect_list(F.struct(F.col("s_nationkey").cast("int").alias("k"), text.alias("v")))).alias("_c")
    code = (F.when(F.col("p_size") == 7, F.lit("N/A"))
            .when(F.col("p_size") == 9, F.concat((F.col("p_partkey") - 1).cast("string"), F.lit(".5")))
            .otherwise(F.col("p_partkey").cast("string")))
    dates = F.collect_list(F.struct("s_nationkey", "last_order")).alias("_last")
    data = land(first.groupBy("sheet", "p_partkey").agg(cell, dates).join(p.hint("shuffle_hash"), "p_partkey").select(
        wb, "sheet", (F.col("p_partkey") + 3).cast("bigint").alias("row_idx"),
        values(code, F.col("p_name"), F.col("p_type"), "_c").alias("values"), "_last"), "template-data")
    comp = (data.select("sheet", F.inline("_last")).groupBy("sheet", "s_nationkey").agg(F.max("last_order").alias("last_order"))
            .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    k = F.col("s_nationkey").cast("int").alias("k")
    head = (F.when((F.col("sheet") == "EUROPE") & (F.col("s_nationkey") == NATIONS - 1), "Descripción")
            .when((F.col("sheet") == "AFRICA") & (F.col("s_nationkey") == NATIONS - 2), F.lit(None).cast("string"))
            .when((F.col("sheet") == "AMERICA") & F.col("s_nationkey").isin(1, 4, 7), "MARKET")
            .otherwise(F.col("n_name")))
    date = F.when(F.col("s_nationkey") == 0, F.lit("sin fecha")).otherwise(F.date_format("last_order", "d/M/yyyy"))
    none = F.lit(None).cast("string")
    tops = comp.groupBy("sheet").agg(F.map_from_entries(F.collect_list(F.struct(k, head.alias("v")))).alias("_h"),
                                     F.map_from_entries(F.collect_list(F.struct(k, date.alias("v")))).alias("_d"))
    tops = tops.select(wb, "sheet", F.inline(F.array(
        F.struct(F.lit(2).cast("bigint").alias("row_idx"),
                 values(F.lit("Código"), F.lit("Descripción"), F.lit("Rubro"), "_h").alias("values")),
        F.struct(F.lit(1).cast("bigint").alias("row_idx"), values(none, none, none, "_d").alias("values")))))
    return data.drop("_last").unionByName(land(tops, "template-tops"))
