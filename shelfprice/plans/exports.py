"""Cluster price publication and sales exports from a cluster sheet.

One job handles every sheet and every cluster block: blocks and header rows
are detected on the cell table, each block becomes records with canonical
columns, and the outputs are single DataFrames keyed by (cluster, tab or
category) — written with ``partitionBy`` instead of one spreadsheet per group.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfprice.functions.flags import ends_in_99, sign_class, valid_price
from shelfprice.functions.text import normalise_ratio, safe_name, strip_cluster_word, to_number
from shelfprice.operators.grid import (block_records, block_records_rows, by_exchange, cells_from_rows,
                                       detect_blocks, detect_header, detect_header_rows,
                                       header_cells, is_row_form, last_columns, last_columns_rows,
                                       top_rows)
from shelfprice.session import delete_folder, freeing_shuffles, land, list_folder, rename

# Fixed values (must equal the reference's behaviour).
# Header aliases of the publication export, in priority order per field:
PUBLICATION_ALIASES = {
    "rubro": ["Rubro"],
    "tipo": ["Tipo"],
    "codigo": ["Cód.", "Cod", "Código"],
    "descripcion": ["Descripción"],
    "sin_iva": ["sin iva"],
    "precio": ["$"],
    "vs_lista": ["VS LISTA ANTERIOR", "Vs lista anterior", "VS LISTA", "VS LISTA ANT"],
    "unidad_me": ["unidad_me"],
}
# Header aliases of the sales export:
SALES_ALIASES = {
    "rubro": ["Rubro"],
    "codigo": ["Cód.", "Cód", "Cod", "Código", "COD_ART"],
    "sin_iva": ["sin iva", "SIN IVA", "SIN_IVA", "Sin Iva", "Sin iva"],
}
# Publication tabs → the category value selected (exact, case-sensitive):
PUBLICATION_TABS = {"Carnes": "Carnes", "Fiambres": "Fiambres", "Reventa": "Dira"}
# Sales export files → the category value selected (upper-cased, trimmed):
SALES_CATEGORIES = {"Carnes": "CARNES", "Fiambres": "FIAMBRES", "Dira": "DIRA"}
# Fixed date text written in every sales row
SALES_DATE_TEXT = "1/1/2019"


def _pairs(spark: SparkSession, mapping: Mapping[str, str], schema: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), schema)


def _records(grid: DataFrame, contains: bool, aliases: Mapping[str, Sequence[str]],
             name_row: int, search_rows: int | None, ranges: bool = False,
             data: Column | None = None) -> DataFrame:
    """``grid`` is a cell table or sheet rows (``values`` array per row); sheet rows
    need no aggregate over the data rows, and are shuffled once, to meet their layout. With
    ``ranges`` they meet it by row ranges (for sheets so large that one task can't hold one).
    ``data`` tells by ``values`` which sheet rows may give a record the caller keeps."""
    if is_row_form(grid):
        tops = land(top_rows(grid, name_row), "sheet-tops")
        names = cells_from_rows(tops.where(F.col("row_idx") == name_row))
        blocks = detect_blocks(names, name_row, last_col=last_columns_rows(grid, bottom=ranges))
        headers = land(detect_header_rows(tops, blocks, contains, search_rows), "sheet-headers")
        heads = land(header_cells(tops, headers), "header-cells")
        rows = grid if data is None else grid.where(data)
        return block_records_rows(rows, headers, aliases, heads)
    blocks = detect_blocks(grid, name_row, last_col=last_columns(grid))
    headers = detect_header(grid, blocks, contains, search_rows)
    return block_records(grid, headers, aliases)


def publication_records(cells: DataFrame, name_row: int = 1,
                        search_rows: int | None = None, ranges: bool = False) -> DataFrame:
    return _records(cells, False, PUBLICATION_ALIASES, name_row, search_rows, ranges)


def sales_records(cells: DataFrame, name_row: int = 1, search_rows: int | None = None,
                  ranges: bool = False, data: Column | None = None) -> DataFrame:
    return _records(cells, True, SALES_ALIASES, name_row, search_rows, ranges, data)


def _gives_types() -> Column:
    """True for the records that a sheet's type map is made from."""
    return F.col("has_tipo") & F.col("has_codigo") & F.col("codigo").isNotNull()


def enrich_missing_type(records: DataFrame, kept: Column | None = None) -> DataFrame:
    """Blocks without a type column but with a code column get the type from the
    first block of the same sheet that has both (first row per code; unknown
    code → ''). Blocks with a type column are left as they are.

    With ``kept`` only those records are returned; the map still comes from all. Only
    records that lack a type are joined, once, with the types asked for: one row per
    (sheet, code), looked up in the map before."""
    key = ["workbook", "sheet"]
    # per sheet the first block with both, per code of that block its first row
    per_block = land(records.where(_gives_types()).groupBy(*key, "block_start", "codigo")
                     .agg(F.min_by("tipo", "row_idx").alias("_map_tipo")), "block-types")
    first = by_exchange(per_block.groupBy(*key).agg(F.min("block_start").alias("block_start")))
    type_map = per_block.join(first, [*key, "block_start"], "left_semi").drop("block_start")
    out = records if kept is None else records.where(kept)
    lacks = ~F.col("has_tipo") & F.col("has_codigo")
    asked = out.where(lacks).select(*key, "codigo").distinct()
    # sheets without a map fill nothing; an unknown code, or none, gives ''
    fills = (asked.join(first.select(*key), key).join(by_exchange(type_map), [*key, "codigo"], "left")
             .select(*[F.col(c).alias(f"_k_{c}") for c in (*key, "codigo")],
                     F.coalesce("_map_tipo", F.lit("")).alias("_fill")))
    filled = (out.where(lacks)
              .join(by_exchange(fills), (F.col("workbook") == F.col("_k_workbook")) & (F.col("sheet") == F.col("_k_sheet"))
                    & F.col("codigo").eqNullSafe(F.col("_k_codigo")), "left")
              .withColumns({"tipo": F.coalesce("_fill", "tipo"),
                            "has_tipo": F.col("_fill").isNotNull()})
              .select(*records.columns))
    return out.where(~lacks).unionByName(filled)


def publication_export(cells: DataFrame) -> DataFrame:
    """Rows of every (cluster, tab) publication file with their flags. Without a
    rubro column a block's rows go to every tab; with a 'sin iva' column only
    rows whose rounded value is non-zero stay."""
    sin_iva, keep = valid_price("sin_iva", round_first=True)
    kept = ((~F.col("has_rubro") | F.col("rubro").isin(*PUBLICATION_TABS.values()))
            & (~F.col("has_sin_iva") | keep))
    # records of no tab serve the type map at most
    recs = land(publication_records(cells).where(_gives_types() | F.coalesce(kept, F.lit(False))), "publication-records")
    recs = enrich_missing_type(recs, kept)
    # every record is offered to each of the (three) tabs: a fixed fan-out
    tabs = F.array(*[F.struct(F.lit(t).alias("tab"), F.lit(r).alias("tab_rubro"))
                     for t, r in PUBLICATION_TABS.items()])
    j = recs.select("*", F.inline(tabs))
    j = j.where(~F.col("has_rubro") | (F.col("rubro") == F.col("tab_rubro")))
    precio = F.bround(to_number("precio"), 0)
    return j.select(
        safe_name(strip_cluster_word(F.col("block_name"))).alias("cluster"), "tab",
        "workbook", "sheet", "block_start", "row_idx",
        "rubro", "tipo", "codigo", "descripcion",
        sin_iva.try_cast("bigint").alias("sin_iva"),
        precio.try_cast("bigint").alias("precio"),
        normalise_ratio("vs_lista").alias("vs_lista"), "unidad_me",
        F.coalesce(ends_in_99(sin_iva), F.lit(False)).alias("sin_iva_ends_99"),
        F.coalesce(ends_in_99(precio), F.lit(False)).alias("precio_ends_99"),
        sign_class(normalise_ratio("vs_lista")).alias("vs_sign"),
    )


def sales_export(cells: DataFrame, list_codes: Mapping[str, str],
                 date_text: str = SALES_DATE_TEXT) -> DataFrame:
    """Rows of every (cluster, category) sales file: code, price, a zero column,
    the fixed date text and the cluster's list code ('' when unknown). Blocks
    lacking any of rubro / code / 'sin iva' produce nothing."""
    spark = cells.sparkSession
    # rows of no category's value give nothing, whatever their layout
    text = F.upper(F.array_join("values", "\n"))
    listed = reduce(or_, (text.contains(v) for v in SALES_CATEGORIES.values()))
    recs = sales_records(cells, data=listed).where(F.col("has_rubro") & F.col("has_codigo") & F.col("has_sin_iva"))
    # both parameters are literal lists of a few rows
    cats = F.broadcast(_pairs(spark, SALES_CATEGORIES, "category string, cat_value string"))
    codes = F.broadcast(_pairs(spark, list_codes, "code_key string, list_code string"))
    rubro = F.upper(F.trim(F.coalesce(F.col("rubro"), F.lit("None"))))
    price = to_number("sin_iva")
    cluster = safe_name(strip_cluster_word(F.trim("block_name")))
    out = (recs.withColumn("_rubro", rubro).withColumn("_price", price)
           .withColumn("cluster", cluster)
           .where(F.col("_price").isNotNull() & (F.col("_price") != 0))
           .join(cats, F.col("_rubro") == F.col("cat_value"))
           .withColumn("_key", strip_cluster_word(F.col("cluster"), upper=True))
           .join(codes, F.col("_key") == F.col("code_key"), "left"))
    return out.select(
        "cluster", "category", F.coalesce(F.col("list_code"), F.lit("")).alias("list_code"),
        "workbook", "sheet", "block_start", "row_idx",
        F.col("codigo"), F.col("_price").alias("precio"), F.lit(0.0).alias("cero"),
        F.lit(date_text).alias("fecha_texto"))


def export_manifest(exports: DataFrame, keys: Sequence[str], process_date: str) -> DataFrame:
    """Files of one process date: one row per output group with its row count."""
    return (exports.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("process_date", F.lit(process_date).cast("date")))


class ExportMismatch(Exception):
    """What lies in the staged folder is not what was to be written."""


def _replace_date(out: DataFrame, path: str, keys: Sequence[str], process_date: str, write, read) -> None:
    """Replace everything an earlier run of ``process_date`` left by one folder per group.
    The files are written beside (names with an underscore are no data to readers), their
    rows counted again from the files, and the folders switched by renames; the old one goes
    last. A run that fails leaves the date as it was. Groups that are empty this time leave
    no file behind; an export without any row removes the date."""
    spark, root = out.sparkSession, path.rstrip("/")
    where, run = f"{root}/process_date={process_date}", uuid.uuid4().hex
    staged, old = f"{root}/_staged-{run}", f"{root}/_old-{run}"
    seen = Observation()
    try:
        with freeing_shuffles(spark):
            write(out.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*keys), staged)
        n = seen.get["n"] or 0
        found = read(staged).count() if n else 0
        if found != n:
            raise ExportMismatch(f"{found} rows in the files of {process_date}, {n} written")
    except BaseException:
        delete_folder(spark, staged)
        raise
    kept = bool(list_folder(spark, where))
    if kept:
        rename(spark, where, old)
    if n and not rename(spark, staged, where):
        rename(spark, old, where)
        delete_folder(spark, staged)
        raise ExportMismatch(f"another run has written {process_date}")
    delete_folder(spark, old)
    if not n:
        delete_folder(spark, staged)


def write_exports(exports: DataFrame, path: str, keys: Sequence[str], process_date: str) -> None:
    """Write Parquet folders ``process_date=…/key=…``; a rerun of the same date replaces
    the whole date."""
    _replace_date(exports, path, keys, process_date, lambda w, where: w.parquet(where),
                  exports.sparkSession.read.schema(exports.schema).parquet)


def plain_number(c: Column) -> Column:
    """A number as text: all its digits, without exponent or trailing zeros."""
    text = F.when(F.abs(c) < 1e7, c.cast("string")).otherwise(c.cast("decimal(38,6)").cast("string"))
    return F.regexp_replace(text, r"\.0*$", "")


def sales_file_lines(exports: DataFrame) -> DataFrame:
    """The lines of every sales file, in the order (cluster, category, line): the list
    code alone on line 0, then code, price (with all its digits), 0.00 and the date text of
    each row in sheet order; no header."""
    order = F.struct("workbook", "sheet", "block_start", "row_idx")
    rows = exports.select("cluster", "category", order.alias("line"), F.col("codigo").alias("a"),
                          plain_number(F.col("precio")).alias("b"), F.format_string("%.2f", "cero").alias("c"),
                          F.col("fecha_texto").alias("d"))
    none = F.lit(None).cast("string")
    # a group's codes (one, as a rule) are made few before the greatest text is sought
    first = (exports.select("cluster", "category", "list_code").distinct()
             .groupBy("cluster", "category").agg(F.max("list_code").alias("a"))
             .select("cluster", "category", F.lit(None).cast(rows.schema["line"].dataType).alias("line"), "a",
                     none.alias("b"), none.alias("c"), none.alias("d")))
    return first.unionByName(rows)


# Lines that one task of a sales write sorts and writes
LINES_PER_TASK = 1 << 20


def write_sales_files(exports: DataFrame, path: str, process_date: str, lines_per_task: int = LINES_PER_TASK) -> None:
    """Sales files as CSV of four columns under ``process_date=…/cluster=…/category=…``,
    the list code first. The lines of all groups are cut into ranges of about
    ``lines_per_task`` in their order, a task each: a group is one file, or, where ranges cut
    it, several that continue each other in the order of their names."""
    exports = land(exports, "sales-rows")  # read for the count, the ranges and the lines
    at = ("cluster", "category", F.asc_nulls_first("line"))
    lines = sales_file_lines(exports)
    tasks = max(1, -(-exports.count() // lines_per_task))
    lines = lines.repartitionByRange(tasks, *at).sortWithinPartitions(*at).drop("line")
    _replace_date(lines, path, ["cluster", "category"], process_date,
                  lambda w, where: w.option("header", "false").option("emptyValue", "").csv(where),
                  lambda where: _read_lines(exports.sparkSession, where))


def _read_lines(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.schema("a string, b string, c string, d string, cluster string, category string").csv(where)


def written_lines(spark: SparkSession, path: str, process_date: str) -> DataFrame:
    """The lines of a date's sales files with their place in the file, from 0 on."""
    back = _read_lines(spark, f"{path.rstrip('/')}/process_date={process_date}")
    # a read split holds lines of one file, in order; the splits, not the lines, are put in a row
    split = ["cluster", "category", "_f", "_b"]
    at = back.select("*", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"))
    before = Window.partitionBy("cluster", "category").orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    splits = (at.groupBy(*split).agg(F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in split]
    # a row per read split, of 128 MB as a rule
    return (at.alias("l").join(F.broadcast(splits.alias("s")), reduce(and_, same))
            .select("l.cluster", "l.category", (F.col("_m") + F.col("_from")).alias("line"), "a", "b", "c", "d"))


def written_manifest(spark: SparkSession, path: str, process_date: str) -> DataFrame:
    """What lies on disk for a process date: one row per group with its data rows."""
    back = _read_lines(spark, f"{path.rstrip('/')}/process_date={process_date}")
    return (back.groupBy("cluster", "category").agg(F.count("b").alias("n_rows"))
            .withColumn("process_date", F.lit(process_date).cast("date")))
