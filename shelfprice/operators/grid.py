"""Spreadsheet grids as a long cell table and the reshapes over it.

A sheet lands as cells ``(workbook, sheet, row_idx, col_idx, value STRING)``
(0-based positions; blank cells may be absent or carry a null value), or, for
dense sheets, as sheet rows ``(workbook, sheet, row_idx, values ARRAY<STRING>)``
(see "sheet rows" below). Every
layout rule (cluster blocks side by side, a header row per block, a dated price
sheet, a competitor template) becomes joins and aggregates on that table, so
any number of sheets and rows is processed in one distributed job.

Windows are used only over the cells of one header row of one sheet (bounded by
the sheet width); everything that scales with the row count is an equi-join or
an aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfprice.functions.dates import parse_dayfirst
from shelfprice.functions.text import norm_key
from shelfprice.session import land

SHEET = ("workbook", "sheet")


def cells_from_wide(df: DataFrame, row_idx: str, columns: Sequence[str],
                    workbook: Column | str, sheet: Column | str,
                    first_col: int = 0) -> DataFrame:
    """Land a header-less wide table (one row per sheet row, positional columns)
    in the cell table; null cells are dropped."""
    wb = F.lit(workbook) if isinstance(workbook, str) else workbook
    sh = F.lit(sheet) if isinstance(sheet, str) else sheet
    arr = F.array(*[F.col(c).cast("string") for c in columns])
    return (df.select(wb.alias("workbook"), sh.alias("sheet"),
                      F.col(row_idx).cast("bigint").alias("row_idx"),
                      F.posexplode(arr).alias("pos", "value"))
              .where(F.col("value").isNotNull())
              .select("workbook", "sheet", "row_idx",
                      (F.col("pos") + first_col).cast("int").alias("col_idx"), "value"))


# ------------------------------------------------------------ cluster blocks

def last_columns(cells: DataFrame) -> DataFrame:
    """(workbook, sheet, _last): the last used column of every sheet (a narrow
    aggregate: two columns of the cell table are read)."""
    return cells.groupBy(*SHEET).agg(F.max("col_idx").alias("_last"))


def by_exchange(layout: DataFrame) -> DataFrame:
    """A layout table (its rows grow with the number of sheets) as a side of a join: it is never
    sent whole through the driver. Repeated texts make a landed one hundreds of times smaller
    as a file than in memory, so the size of the file says nothing."""
    return layout.hint("merge")


def detect_blocks(cells: DataFrame, name_row: int = 1,
                  last_col: DataFrame | None = None) -> DataFrame:
    """Blocks laid out side by side: on ``name_row`` a non-empty cell opens a
    block that extends over the following empty cells, up to the next name or the
    sheet's last used column. Leading empty columns belong to no block.
    ``cells`` may be just the header zone when ``last_col`` (from
    :func:`last_columns` over all cells) is given.

    Returns (workbook, sheet, block_start, block_end, block_name)."""
    names = (cells.where((F.col("row_idx") == name_row) & (F.trim(F.col("value")) != ""))
             .select(*SHEET, "col_idx", F.trim(F.col("value")).alias("block_name")))
    if last_col is None:
        last_col = last_columns(cells)
    w = Window.partitionBy(*SHEET).orderBy("col_idx")
    return (names.withColumn("_next", F.lead("col_idx").over(w))
            .join(by_exchange(last_col), list(SHEET))
            .select(*SHEET, F.col("col_idx").alias("block_start"),
                    F.coalesce(F.col("_next") - 1, F.col("_last")).alias("block_end"),
                    "block_name", *[c for c in last_col.columns if c == "_bottom"]))


def header_match(value: Column, contains: bool) -> Column:
    k = norm_key(value)
    return k.contains("rubro") if contains else (k == "rubro")


def detect_header(cells: DataFrame, blocks: DataFrame, contains: bool = False,
                  search_rows: int | None = None) -> DataFrame:
    """Header row of each block: the first row whose cell in the block's first
    column is 'rubro' (normalised), or contains it with ``contains=True``. The whole
    sheet is searched unless the caller gives a depth. Blocks without a header are
    dropped.

    Returns the block columns plus ``header_row``."""
    first = blocks.select(*SHEET, F.col("block_start").alias("col_idx"))
    if search_rows is not None:
        cells = cells.where(F.col("row_idx") < search_rows)
    hits = (cells.join(by_exchange(first), [*SHEET, "col_idx"])
            .where(F.col("value").isNotNull() & (F.trim(F.col("value")) != "")
                   & header_match(F.col("value"), contains))
            .groupBy(*SHEET, F.col("col_idx").alias("block_start"))
            .agg(F.min("row_idx").alias("header_row")))
    return blocks.join(by_exchange(hits), [*SHEET, "block_start"], "inner")


def top_rows(rows: DataFrame, name_row: int = 1) -> DataFrame:
    """The sheet rows that the layout is read from: the name row, and every row that may be a
    header row (some cell contains 'rubro'). Each row is judged by itself, so that the rows
    below are neither joined nor shuffled in search of the layout."""
    # a line break between cells: no match spans two of them
    may_be_header = F.lower(F.array_join("values", "\n")).contains("rubro")
    return rows.where((F.col("row_idx") == name_row) | may_be_header)


def detect_header_rows(rows: DataFrame, blocks: DataFrame, contains: bool = False,
                       search_rows: int | None = None) -> DataFrame:
    """:func:`detect_header` over sheet rows: each row is tested in the first column of
    the sheet's blocks (a handful), without exploding it to cells. ``rows`` may be just the
    :func:`top_rows`."""
    if search_rows is not None:
        rows = rows.where(F.col("row_idx") < search_rows)
    value = F.try_element_at("values", F.col("block_start") + 1)
    hits = (join_layout(rows, by_exchange(blocks.drop("block_end", "block_name")))
            .where(value.isNotNull() & (F.trim(value) != "") & header_match(value, contains))
            .groupBy(*SHEET, "block_start").agg(F.min("row_idx").alias("header_row")))
    return blocks.join(by_exchange(hits), [*SHEET, "block_start"], "inner")


def header_cells(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells of the header rows only (``rows``: all, or the :func:`top_rows`)."""
    at = headers.select(*SHEET, F.col("header_row").alias("row_idx")).distinct()
    return cells_from_rows(rows.join(by_exchange(at), [*SHEET, "row_idx"], "left_semi"))


def block_column_map(headers: DataFrame) -> DataFrame:
    """(workbook, sheet, col_idx) → its block; one row per block column."""
    return headers.select(*SHEET, "block_start", "header_row",
                          F.explode(F.sequence(F.col("block_start"), F.col("block_end")))
                          .alias("col_idx"))


def alias_table(spark: SparkSession, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """(field, cand_key, cand_rank) from a {field: [candidate headers]} parameter."""
    rows = [(field, cand, rank) for field, cands in aliases.items()
            for rank, cand in enumerate(cands)]
    df = spark.createDataFrame(rows, "field string, cand string, cand_rank int")
    return df.select("field", norm_key("cand").alias("cand_key"), "cand_rank").distinct()


def resolve_columns(cells: DataFrame, headers: DataFrame,
                    aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Resolve each canonical field to one column per block: the header text is
    normalised (whitespace collapsed, trimmed, lower case); the first candidate
    present wins, and when several columns carry that name the later one wins.

    Returns (workbook, sheet, block_start, field, col_idx)."""
    spark = cells.sparkSession
    colmap = block_column_map(headers)
    head = (cells.join(by_exchange(colmap), [*SHEET, "col_idx"])
            .where(F.col("row_idx") == F.col("header_row"))
            .select(*SHEET, "block_start", "col_idx", norm_key("value").alias("key")))
    # the alias parameter is a literal list of a few dozen names
    cand = F.broadcast(alias_table(spark, aliases))
    m = head.join(cand, head["key"] == cand["cand_key"])
    pick = F.min_by(F.col("col_idx"), F.struct(F.col("cand_rank"), -F.col("col_idx")))
    return m.groupBy(*SHEET, "block_start", "field").agg(pick.alias("col_idx"))


def block_records(cells: DataFrame, headers: DataFrame,
                  aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each block as a table: the rows below its header row become records with
    one column per canonical field (null when the block lacks it); rows whose
    cells in the block are all empty are dropped. Adds ``has_<field>`` flags.

    Returns (workbook, sheet, block_start, block_name, row_idx, <fields>,
    has_<fields>)."""
    fields = list(aliases)
    resolved = resolve_columns(cells, headers, aliases)
    colmap = block_column_map(headers).join(
        by_exchange(resolved), [*SHEET, "block_start", "col_idx"], "left")
    data = (cells.where(F.col("value").isNotNull())
            .join(by_exchange(colmap), [*SHEET, "col_idx"])
            .where(F.col("row_idx") > F.col("header_row")))
    recs = data.groupBy(*SHEET, "block_start", "row_idx").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    has = resolved.groupBy(*SHEET, "block_start").agg(
        *[F.max(F.col("field") == f).alias(f"has_{f}") for f in fields])
    info = headers.select(*SHEET, "block_start", "block_name").join(
        by_exchange(has), [*SHEET, "block_start"], "left").fillna(False, [f"has_{f}" for f in fields])
    return recs.join(by_exchange(info), [*SHEET, "block_start"]).select(
        *SHEET, "block_start", "block_name", "row_idx", *fields,
        *[f"has_{f}" for f in fields])


# ------------------------------------------------------------- sheet rows
#
# A sheet reader emits a sheet row by row: (workbook, sheet, row_idx,
# values ARRAY<STRING>) with values[i] the cell in column i (null when blank).
# The name row and the header rows are exploded to cells; the header search tests one
# element of each row per block. The records are a narrow projection of every data row
# (``try_element_at`` per field) after a join with the per-block layout. String cells
# never reach an aggregation buffer (which would force a sort-based aggregate).
#
# Where the layout holds each sheet's last row index, data rows meet it by sheet and row
# range: it is copied to every range of ``RANGE_ROWS`` rows of its sheet, so that one huge
# sheet is spread over all tasks by the join's own keys, whatever AQE does. Row indexes
# count from 0. Many small sheets are better joined by sheet alone.

RANGE_ROWS = 1 << 13


def join_layout(rows: DataFrame, layout: DataFrame, range_rows: int = RANGE_ROWS,
                how: str = "inner") -> DataFrame:
    """``rows`` with the layout rows of their sheet, joined by (workbook, sheet, row
    range). ``layout`` holds the sheet's last row index as ``_bottom``; without it the
    join is by sheet alone. Rows without a workbook, sheet or row index meet none."""
    if "_bottom" not in layout.columns:
        return rows.join(layout, list(SHEET), how)
    copies = layout.withColumn("_range", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor(F.col("_bottom") / range_rows).cast("bigint"))))
    ranged = rows.withColumn("_range", F.floor(F.col("row_idx") / range_rows).cast("bigint"))
    return ranged.join(copies, [*SHEET, "_range"], how).drop("_range")


def is_row_form(grid: DataFrame) -> bool:
    return "values" in grid.columns


def cells_from_rows(rows: DataFrame) -> DataFrame:
    """Row form → cell table (non-null cells only)."""
    return (rows.select(*SHEET, "row_idx", F.posexplode("values").alias("col_idx", "value"))
            .where(F.col("value").isNotNull())
            .select(*SHEET, "row_idx", F.col("col_idx").cast("int").alias("col_idx"), "value"))


def rows_from_cells(cells: DataFrame) -> DataFrame:
    """Cell table → row form (one aggregate; for inputs that arrive as cells).
    A repeated (row, column) keeps the largest value, as the cell path does."""
    cells = cells.where(F.col("value").isNotNull())
    got = cells.groupBy(*SHEET, "row_idx").agg(
        F.collect_list(F.struct("col_idx", "value")).alias("_c"),
        F.max("col_idx").alias("_w"))
    values = F.transform(
        F.sequence(F.lit(0), F.col("_w")),
        lambda i: F.array_max(F.transform(F.filter("_c", lambda c: c["col_idx"] == i),
                                          lambda c: c["value"])))
    return got.select(*SHEET, "row_idx", values.alias("values"))


def last_columns_rows(rows: DataFrame, bottom: bool = False) -> DataFrame:
    """(workbook, sheet, _last): last column holding a value in each sheet; with ``bottom``
    also its last row index, ``_bottom``."""
    last = F.array_max(F.transform("values", lambda x, i: F.when(x.isNotNull(), i)))
    return rows.groupBy(*SHEET).agg(F.max(last).alias("_last"),
                                    *([F.max("row_idx").alias("_bottom")] if bottom else []))


def block_layout(headers: DataFrame, resolved: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per block: its span, name, header row and, per canonical field,
    the resolved column (``_c_<field>``, null when absent) and ``has_<field>``."""
    cols = resolved.groupBy(*SHEET, "block_start").agg(
        *[F.max(F.when(F.col("field") == f, F.col("col_idx"))).alias(f"_c_{f}") for f in fields])
    return (headers.select(*SHEET, "block_start", "block_end", "block_name", "header_row",
                           *[c for c in headers.columns if c == "_bottom"])
            .join(by_exchange(cols), [*SHEET, "block_start"], "left")
            .select("*", *[F.col(f"_c_{f}").isNotNull().alias(f"has_{f}") for f in fields]))


def block_records_rows(rows: DataFrame, headers: DataFrame,
                       aliases: Mapping[str, Sequence[str]], heads: DataFrame) -> DataFrame:
    """:func:`block_records` over sheet rows; same output. ``heads``: the cells of the
    header rows (:func:`header_cells`)."""
    fields = list(aliases)
    resolved = resolve_columns(heads, headers, aliases)
    # a handful of rows per sheet: the hash side, so that the sheet rows need no sort
    layout = block_layout(headers, resolved, fields).hint("shuffle_hash")
    j = join_layout(rows, layout).where(F.col("row_idx") > F.col("header_row"))
    span = F.slice("values", F.col("block_start") + 1, F.col("block_end") - F.col("block_start") + 1)
    j = j.where(F.exists(span, lambda x: x.isNotNull()))
    return j.select(
        *SHEET, "block_start", "block_name", "row_idx",
        *[F.try_element_at("values", F.col(f"_c_{f}") + 1).alias(f) for f in fields],
        *[f"has_{f}" for f in fields])


# ------------------------------------------------------ dated price history

def unpivot_history_rows(rows: DataFrame, date_row: int = 3, data_row: int = 4,
                         first_price_col: int = 3, step: int = 3,
                         range_rows: int = RANGE_ROWS,
                         parse_date: Callable[[Column], Column] | None = None) -> DataFrame:
    """:func:`unpivot_history` over sheet rows: each row meets its sheet's date row once and
    gives its price cells; base columns are elements of the row itself."""
    dates = (rows.where(F.col("row_idx") == date_row).groupBy(*SHEET)
             .agg(F.max("values").alias("_dates")))  # one row per sheet
    if parse_date is not None:
        dates = dates.withColumn("_parsed", F.transform("_dates", parse_date))
    # landed, its size is known: while it is small, the sheet rows are not shuffled to meet it
    layout = land(rows.groupBy(*SHEET).agg(F.max("row_idx").alias("_bottom"))
                  .join(dates, list(SHEET), "left"), "history-layout")
    data = join_layout(rows.where(F.col("row_idx") >= data_row), layout, range_rows)
    # only price columns are looked at, and only cells with a price are built
    columns = F.when(F.size("values") > first_price_col,
                     F.sequence(F.lit(first_price_col), F.size("values") - 1, F.lit(step)))
    present = F.filter(columns, lambda i: F.try_element_at("values", i + 1).isNotNull())
    priced = F.transform(present, lambda i: F.struct(
        i.cast("int").alias("col_idx"), F.try_element_at("_dates", i + 1).alias("date_value"),
        F.try_element_at("values", i + 1).alias("price_value"),
        *([F.try_element_at("_parsed", i + 1).alias("date_parsed")] if parse_date is not None else [])))
    base = [F.try_element_at("values", F.lit(i + 1)).alias(n)
            for i, n in enumerate(("rubro", "cod_text", "producto"))]
    return data.select(*SHEET, "row_idx", *base, F.inline(priced))


def unpivot_history(cells: DataFrame, date_row: int = 3, data_row: int = 4,
                    first_price_col: int = 3, step: int = 3,
                    parse_date: Callable[[Column], Column] | None = None) -> DataFrame:
    """A wide dated price sheet → long rows. Base columns 0-2 are (rubro,
    cod_art, producto); price columns are ``first_price_col`` and every ``step``-th
    after it, each dated by its cell on ``date_row``; data starts on ``data_row``.
    Empty price cells produce no row. ``cells``: a cell table, or sheet rows (no
    aggregate over cells then). ``parse_date`` is applied to every date cell, once for its
    whole column.

    Returns (workbook, sheet, row_idx, col_idx, rubro, cod_text, producto,
    date_value, price_value), and ``date_parsed`` with ``parse_date``."""
    if is_row_form(cells):
        return unpivot_history_rows(cells, date_row, data_row, first_price_col, step, parse_date=parse_date)
    is_price_col = (F.col("col_idx") >= first_price_col) & \
        (((F.col("col_idx") - first_price_col) % step) == 0)
    prices = cells.where((F.col("row_idx") >= data_row) & is_price_col
                         & F.col("value").isNotNull()) \
        .select(*SHEET, "row_idx", "col_idx", F.col("value").alias("price_value"))
    dates = cells.where((F.col("row_idx") == date_row) & is_price_col) \
        .select(*SHEET, "col_idx", F.col("value").alias("date_value"))
    if parse_date is not None:
        dates = dates.withColumn("date_parsed", parse_date(F.col("date_value")))
    # a row per price column of a sheet. Landed, its size is known: while it is small, prices
    # are not shuffled by column, of which there are few
    dates = land(dates, "history-dates")
    base = (cells.where((F.col("row_idx") >= data_row) & (F.col("col_idx") < first_price_col))
            .groupBy(*SHEET, "row_idx")
            .agg(F.max(F.when(F.col("col_idx") == 0, F.col("value"))).alias("rubro"),
                 F.max(F.when(F.col("col_idx") == 1, F.col("value"))).alias("cod_text"),
                 F.max(F.when(F.col("col_idx") == 2, F.col("value"))).alias("producto")))
    return (prices.join(dates, [*SHEET, "col_idx"], "left")
            .join(base, [*SHEET, "row_idx"], "left"))


# ---------------------------------------------------- competitor template

# Header texts of the code and description columns
CODE_HEADER, DESCRIPTION_HEADER = "Código", "Descripción"


def _blank_as_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def template_layout(rows: DataFrame, date_row: int = 1, header_row: int = 2) -> DataFrame:
    """One row per template sheet: the header and date rows as arrays (``_h``, ``_d``),
    the sheet's width (``_w``) and the position of the code column (``_code``, by its
    header; sheets without one are left out)."""
    head = F.max(F.when(F.col("row_idx") == header_row, F.col("values"))).alias("_h")
    dates = F.max(F.when(F.col("row_idx") == date_row, F.col("values"))).alias("_d")
    top = rows.where(F.col("row_idx").isin(date_row, header_row)).groupBy(*SHEET).agg(head, dates)
    width = rows.groupBy(*SHEET).agg(F.max(F.size("values")).alias("_w"))
    code = F.array_position(F.transform("_h", lambda h: F.coalesce(F.trim(h), F.lit(""))), CODE_HEADER) - 1
    return top.join(width, list(SHEET)).withColumn("_code", code.cast("int")).where("_code >= 0")


def _column_names(first_col: int) -> Column:
    """The competitor of every column of a sheet from ``first_col`` on, by the header array
    ``_h`` and the width ``_w``: a header that stands further left already gets its
    occurrence number, so that it names a competitor of its own."""
    def name(i: Column) -> Column:
        h = _blank_as_null(F.try_element_at("_h", i + 1))
        again = F.size(F.filter(F.slice("_h", F.lit(1), i), lambda x: x == h))
        return (F.when(h.isNull(), F.concat(F.lit("Unnamed: "), i.cast("string")))
                .when(again > 0, F.concat(h, F.lit("."), again.cast("string")))
                .when(F.trim(h) == DESCRIPTION_HEADER, "descripcion").otherwise(h))
    return F.transform(F.sequence(F.lit(first_col), F.col("_w") - 1), name)


def _column_dates() -> Column:
    """The date cell of every name in ``_names``: that of the last column with this header
    and a date above it. Base headers and numbered names have none of their own."""
    columns = F.arrays_zip(F.col("_h").alias("h"), F.slice("_d", F.lit(1), F.size("_h")).alias("d"))
    dated = F.filter(columns, lambda c: _blank_as_null(c["d"]).isNotNull()
                     & ~F.trim(c["h"]).isin(CODE_HEADER, DESCRIPTION_HEADER))
    return F.transform("_names", lambda n: F.try_element_at(
        F.filter(dated, lambda c: F.trim(c["h"]) == F.trim(n)), F.lit(-1))["d"])


def melt_template(grid: DataFrame, data_row: int = 3, date_row: int = 1, header_row: int = 2,
                  first_col: int = 3, by_code: bool = False) -> DataFrame:
    """Competitor template sheets → long (code, competitor, price text) rows.

    ``grid``: sheet rows, or cells (which become sheet rows first). The code column is
    found by its header. Rows whose code is not numeric are dropped (codes truncate to
    integers). Every column from ``first_col`` on with some value on a remaining row is
    a competitor; each remaining row then gives a row, with a null price where the cell
    is blank or absent. A column without header is named by its position, one with the
    description header by that field, one whose header stands further left already by the
    header and a number; none of these has a date. Other dates are the cell above the last
    column of that header that has one: a date or day-first text; unparsable → null. With
    ``by_code`` the rows of a sheet name and code meet in one task while they are sheet rows:
    an aggregate by code over the result needs no exchange of its many cells.

    Returns (workbook, sheet, row_idx, col_idx, cod_art, competencia,
    price_value, fecha_modificacion)."""
    from shelfprice.functions.text import code_or_null
    rows = grid if is_row_form(grid) else rows_from_cells(grid)
    layout = (template_layout(rows, date_row, header_row).where(F.col("_w") > first_col)
              .withColumn("_names", _column_names(first_col)).withColumn("_dates", _column_dates())
              .select(*SHEET, "_code", "_names",
                      F.transform("_dates", lambda d: parse_dayfirst(d).cast("date")).alias("_dates")))
    # a row per sheet. Landed, its size is known: while it is small, the sheet rows are not
    # shuffled by sheet, of which there are few
    layout = land(layout, "template-layout")
    data = rows.where(F.col("row_idx") >= data_row).join(layout, list(SHEET))
    data = (data.withColumn("cod_art", code_or_null(F.try_element_at("values", F.col("_code") + 1)))
            .where(F.col("cod_art").isNotNull()))

    def cells(data: DataFrame) -> DataFrame:
        return (data.select(*SHEET, "row_idx", "cod_art", "_code", "values", "_names", "_dates",
                            F.posexplode("_names").alias("_k", "competencia"))
                .withColumn("col_idx", F.col("_k") + first_col).where("col_idx <> _code")
                .select(*SHEET, "row_idx", "col_idx", "cod_art", "competencia",
                        _blank_as_null(F.try_element_at("values", F.col("col_idx") + 1)).alias("price_value"),
                        F.try_element_at("_dates", F.col("_k") + 1).alias("fecha_modificacion")))
    # likewise: a row per column
    filled = land(cells(data).where(F.col("price_value").isNotNull()).select(*SHEET, "col_idx").distinct(),
                  "template-columns")
    if by_code:
        # the number is given: few bytes of sheet rows are many cells, so tasks are not merged
        tasks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # the layout's arrays do not travel with the rows: they are met again behind the exchange
        rows_by_code = (data.drop("_names", "_dates").repartition(tasks, "sheet", "cod_art")
                        .join(layout.drop("_code"), list(SHEET)))
        return cells(rows_by_code).join(filled, [*SHEET, "col_idx"], "left_semi")
    return cells(data).join(filled, [*SHEET, "col_idx"], "left_semi")
