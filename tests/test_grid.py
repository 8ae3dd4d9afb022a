"""Cell-table operators: blocks, headers, aliases, records, history unpivot, template."""

import pytest

from shelfprice.operators.grid import (block_records, detect_blocks, detect_header,
                                       melt_template, unpivot_history)
from shelfprice.operators.position import grouped_position
from shelfprice.plans.exports import (PUBLICATION_ALIASES, enrich_missing_type,
                                      publication_export, sales_export)
from shelfprice.plans.loads import history_load, history_rejects, template_load

CELL = "workbook string, sheet string, row_idx long, col_idx int, value string"


def cells(spark, rows):
    return spark.createDataFrame([("w", "s", r, c, v) for r, c, v in rows], CELL)


def test_detect_blocks(spark):
    df = cells(spark, [(1, 1, "A"), (1, 4, "B"), (5, 5, "x"), (5, 0, "lead")])
    got = sorted((r.block_name, r.block_start, r.block_end) for r in detect_blocks(df).collect())
    # column 0 (a leading blank on the name row) belongs to no block; B runs to the last used column
    assert got == [("A", 1, 3), ("B", 4, 5)]


def test_detect_header_modes(spark):
    df = cells(spark, [(1, 0, "A"), (1, 2, "B"), (1, 4, "C"),
                       (3, 0, " RUBRO "), (3, 2, "Sub Rubro"), (305, 4, "Rubro")])
    blocks = detect_blocks(df)
    exact = {r.block_name: r.header_row for r in detect_header(df, blocks, False, 299).collect()}
    contains = {r.block_name: r.header_row for r in detect_header(df, blocks, True, 300).collect()}
    assert exact == {"A": 3}
    assert contains == {"A": 3, "B": 3}
    # by default the whole sheet is searched
    whole = {r.block_name: r.header_row for r in detect_header(df, blocks).collect()}
    assert whole == {"A": 3, "C": 305}


def test_aliases_first_candidate_and_later_column(spark):
    rows = [(1, 0, "CL"), (2, 0, "Rubro"), (2, 1, "Código"), (2, 2, "Cod"), (2, 3, "cod"),
            (2, 4, "sin  IVA"), (3, 0, "Carnes"), (3, 1, "c1"), (3, 2, "c2"), (3, 3, "c3"),
            (3, 4, "10")]
    df = cells(spark, rows)
    headers = detect_header(df, detect_blocks(df), False, 299)
    rec = block_records(df, headers, PUBLICATION_ALIASES).collect()
    assert len(rec) == 1
    # 'Cod' is the second candidate and beats 'Código' (third); of the two 'cod' columns the later wins
    assert rec[0].codigo == "c3" and rec[0].sin_iva == "10" and rec[0].has_tipo is False


def test_records_drop_blank_rows_and_enrich_type(spark):
    rows = [(1, 0, "CLUSTER A"), (1, 3, "CLUSTER B"),
            (2, 0, "Rubro"), (2, 1, "Tipo"), (2, 2, "Cód."),
            (2, 3, "Rubro"), (2, 4, "Cod"), (2, 5, "sin iva"),
            (3, 0, "Carnes"), (3, 1, "T1"), (3, 2, "7"),
            (3, 3, "Carnes"), (3, 4, "7"), (3, 5, "0.4"),
            (4, 3, "Dira"), (4, 4, "8"), (4, 5, "12.6"),
            (6, 3, "Fiambres"), (6, 4, "9"), (6, 5, "199")]
    df = cells(spark, rows)
    pub = {(r.cluster, r.tab, r.row_idx): r for r in publication_export(df).collect()}
    # block A has no 'sin iva' column: no gate; block B drops 0.4 (rounds to 0)
    assert ("A", "Carnes", 3) in pub and ("B", "Carnes", 3) not in pub
    assert pub[("B", "Reventa", 4)].tipo == ""      # code 8 unknown to block A
    assert pub[("B", "Reventa", 4)].sin_iva == 13
    assert pub[("B", "Fiambres", 6)].sin_iva_ends_99 is True
    sales = sales_export(df, {"B": "PubB"}).collect()
    assert sorted((r.cluster, r.category, r.precio, r.list_code) for r in sales) == \
        [("B", "Carnes", 0.4, "PubB"), ("B", "Dira", 12.6, "PubB"),
         ("B", "Fiambres", 199.0, "PubB")]


def test_enrich_keeps_existing_type(spark):
    rows = [(1, 0, "A"), (2, 0, "Rubro"), (2, 1, "Tipo"), (2, 2, "Cod"),
            (3, 0, "Carnes"), (3, 2, "5")]
    df = cells(spark, rows)
    headers = detect_header(df, detect_blocks(df), False, 299)
    rec = enrich_missing_type(block_records(df, headers, PUBLICATION_ALIASES)).collect()
    assert rec[0].tipo is None and rec[0].has_tipo is True


def test_history_unpivot_rules(spark):
    rows = [(3, 3, "1/2/2024"), (3, 6, "junio"),
            (4, 0, "r"), (4, 1, "12.7"), (4, 2, "prod"), (4, 3, "10,5"), (4, 6, "3"),
            (5, 0, "r"), (5, 1, ""), (5, 3, "0"),
            (6, 0, "r"), (6, 1, "x"), (6, 2, "p2"), (6, 3, "s/p"), (6, 4, "99")]
    df = cells(spark, rows)
    lists = spark.createDataFrame([(7, "s")], "list_id int, list_name string")
    got = sorted((r.cod_art, r.producto, r.precio) for r in history_load(df, lists).collect())
    # 10,5 is not numeric; '0' is kept; blank code with no product is dropped; 'junio' never parses
    assert got == []
    raw = {(r.row_idx, r.col_idx): r.reject_reason for r in history_rejects(df, lists).collect()}
    assert raw[(4, 3)] == "no_price" and raw[(4, 6)] == "bad_date"
    assert raw[(5, 3)] == "no_code_no_product" and raw[(6, 3)] == "no_price"
    rows2 = [(3, 3, "1/2/2024"), (4, 1, "12.7"), (4, 2, "prod"), (4, 3, "10.5"),
             (5, 1, ""), (5, 2, "p5"), (5, 3, "0"), (6, 1, "x"), (6, 2, "p6"), (6, 3, "2")]
    got = sorted((r.cod_art, r.producto, r.precio) for r in history_load(cells(spark, rows2), lists).collect())
    assert got == [(0, "p5", 0.0), (0, "p6", 2.0), (12, "prod", 10.5)]
    # the code 'x' loads as 0 and is reported; without its list nothing of a sheet loads
    rej = [(r.row_idx, r.reject_reason, r.loaded) for r in history_rejects(cells(spark, rows2), lists).collect()]
    assert rej == [(6, "bad_code", True)]
    other = spark.createDataFrame([(7, "another")], "list_id int, list_name string")
    assert history_load(cells(spark, rows2), other).count() == 0
    assert {r.reject_reason for r in history_rejects(cells(spark, rows2), other).collect()} == {"unknown_list"}


def test_template_melt_rules(spark):
    rows = [(1, 3, "5/10/2001"), (1, 4, "sin fecha"), (1, 5, "1/1/2001"),
            (2, 0, "Código"), (2, 1, "Descripción"), (2, 2, "Rubro"),
            (2, 3, "Comp A"), (2, 4, "Comp B"), (2, 5, "Comp C"),
            (3, 0, "10"), (3, 3, "$ 1.234,56"), (3, 4, None),
            (4, 0, "N/A"), (4, 5, "7"),
            (5, 0, "10.5"), (5, 3, None), (5, 4, "2,5")]
    df = cells(spark, rows)
    got = sorted((r.cod_art, r.competencia, r.precio, r.fecha_modificacion is None)
                 for r in template_load(df, ["s", "missing"], "2024-12-30").collect())
    from decimal import Decimal
    # code 10 appears twice: the later row (code '10.5') wins, even with a null price;
    # Comp C only has a value on a row with an invalid code: the column is dropped
    assert got == [(10, "Comp A", None, False), (10, "Comp B", Decimal("2.5000"), True)]
    assert {(r.anio, r.semana) for r in template_load(df, ["s"], "2024-12-30").collect()} == {(2024, 1)}


def test_template_blanks_headers_and_moved_code(spark):
    base = [(1, 3, "5/10/2001"), (1, 4, "1/1/2001"), (1, 5, "2/2/2002"),
            (2, 0, "Rubro"), (2, 1, "Descripción"), (2, 2, " Código "), (2, 3, "Comp A"), (2, 4, "Descripción"),
            (3, 2, "10"), (3, 3, "5"), (3, 5, "8"), (4, 2, "11"), (4, 4, "7"), (5, 2, "10")]
    blanks = [(3, 4, None), (4, 3, None), (5, 3, ""), (5, 4, None), (5, 5, None)]
    # the second description header is a repeated one: numbered, and no base column
    want = [(10, "Comp A", None, True), (10, "Descripción.1", None, False), (10, "Unnamed: 5", None, False),
            (11, "Comp A", None, True), (11, "Descripción.1", 7.0, False), (11, "Unnamed: 5", None, False)]
    for rows in (base, base + blanks):  # a blank cell that is there and one that is not are the same
        got = template_load(cells(spark, rows), ["s"], "2024-12-30").collect()
        assert sorted((r.cod_art, r.competencia, None if r.precio is None else float(r.precio),
                       r.fecha_modificacion is not None) for r in got) == want


def test_template_repeated_headers(spark):
    rows = [(1, 3, "1/1/2001"), (1, 4, "2/2/2002"), (1, 6, "3/3/2003"),
            (2, 0, "Código"), (2, 1, "Descripción"), (2, 2, "Rubro"),
            (2, 3, "X"), (2, 4, "X"), (2, 5, "X"), (2, 6, "Y "), (2, 7, "Código"), (2, 8, "Y "),
            (3, 0, "10"), (3, 3, "5"), (3, 4, "7"), (3, 5, "9"), (3, 6, "1"), (3, 7, "2"), (3, 8, "3")]
    got = {r.competencia: (float(r.precio), str(r.fecha_modificacion)) for r in
           template_load(cells(spark, rows), ["s"], "2024-12-30").collect()}
    # both columns load; the date of a header is that of its last dated column, numbered names have none
    assert got == {"X": (5.0, "2002-02-02"), "X.1": (7.0, "None"), "X.2": (9.0, "None"), "Y ": (1.0, "2003-03-03"),
                   "Código.1": (2.0, "None"), "Y .1": (3.0, "None")}


def test_grouped_position_matches_rank(spark):
    df = spark.createDataFrame([(i % 5, "c%03d" % i) for i in range(300)], "r int, c string").repartition(7)
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        got = sorted((r.r, r.c, r.pos) for r in grouped_position(df, ["r"], ["c"], "pos").collect())
        assert [g[2] for g in got] == list(range(300))
    spark.conf.unset("spark.sql.exchange.reuse")


def test_header_below_row_300_in_row_form(spark):
    from shelfprice.operators.grid import rows_from_cells
    rows = [(1, 0, "CLUSTER A"), (400, 0, "Rubro"), (400, 1, "Cod"), (400, 2, "sin iva"),
            (401, 0, "Carnes"), (401, 1, "7"), (401, 2, "5")]
    df = rows_from_cells(cells(spark, rows))
    assert [(r.cluster, r.tab, r.codigo, r.sin_iva) for r in publication_export(df).collect()] == [("A", "Carnes", "7", 5)]
    assert [(r.cluster, r.codigo) for r in sales_export(df, {}).collect()] == [("A", "7")]


def test_row_form_matches_cell_form(spark):
    """Sheet rows (values array per row) give the same records and exports as
    the cell table they come from."""
    from shelfprice.operators.grid import cells_from_rows, rows_from_cells
    rows = [(1, 0, "CLUSTER A"), (1, 3, "CLUSTER B"), (1, 6, "C"),
            (2, 0, "Rubro"), (2, 1, "Tipo"), (2, 2, "Cód."),
            (2, 3, "Rubro"), (2, 4, "Cod"), (2, 5, "sin iva"), (3, 6, " rubro"), (3, 7, "Código"),
            (3, 0, "Carnes"), (3, 1, "T1"), (3, 2, "7"),
            (3, 3, "Carnes"), (3, 4, "7"), (3, 5, "0.4"),
            (4, 3, "Dira"), (4, 4, "8"), (4, 5, "12.6"), (4, 8, "x"),
            (5, 1, "only tipo"), (6, 3, "Fiambres"), (6, 4, "9"), (6, 5, "199"), (7, 9, "late")]
    df = cells(spark, rows)
    sheet_rows = rows_from_cells(df)
    assert sorted(map(tuple, cells_from_rows(sheet_rows).collect())) == \
        sorted(map(tuple, df.collect()))
    for fn in (publication_export, lambda g: sales_export(g, {"B": "PubB"})):
        assert sorted(map(tuple, fn(sheet_rows).collect())) == sorted(map(tuple, fn(df).collect()))


def test_row_form_last_column_ignores_trailing_blanks(spark):
    from shelfprice.operators.grid import cells_from_rows, last_columns_rows
    rows = spark.createDataFrame(
        [("w", "s", 1, ["A", None, "B", None, None]), ("w", "s", 2, [None, "x"]),
         ("w", "t", 1, [None, None, None])],
        "workbook string, sheet string, row_idx long, values array<string>")
    last = {r.sheet: r._last for r in last_columns_rows(rows).collect()}
    assert last == {"s": 2, "t": None}
    assert sorted((r.row_idx, r.col_idx, r.value) for r in cells_from_rows(rows).collect()) == \
        [(1, 0, "A"), (1, 2, "B"), (2, 1, "x")]


def test_history_row_form_matches_cell_form(spark):
    from shelfprice.operators.grid import rows_from_cells, unpivot_history_rows
    rows = [(0, 0, "title"), (3, 3, "1/2/2024"), (3, 6, "junio"),
            (4, 0, "r"), (4, 1, "12.7"), (4, 2, "prod"), (4, 3, "10.5"), (4, 4, "1"), (4, 6, "3"),
            (5, 1, ""), (5, 3, "0"), (9000, 2, "p2"), (9000, 3, "s/p"), (9000, 9, "no date")]
    df = cells(spark, rows)
    bare = spark.createDataFrame([("w", "t", 4, 3, "5"), ("w", "t", 4, 1, "8")], CELL)  # a sheet without dates
    df = df.unionByName(bare)
    want = unpivot_history(df)
    for n in (1, 2, 8192):
        got = unpivot_history_rows(rows_from_cells(df), range_rows=n).select(want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert unpivot_history(rows_from_cells(df.limit(0))).count() == 0


def test_hot_sheet_is_spread_by_row_ranges(spark):
    """One sheet with nearly all rows: its rows meet the layout in many tasks without AQE."""
    from pyspark.sql import functions as F
    from shelfprice.operators.grid import join_layout
    from shelfprice.plans.exports import publication_records
    heads = [("w", s, r, v) for s in ("hot", "small") for r, v in
             ((1, ["CLUSTER A", None, None]), (2, ["Rubro", "Cod", "sin iva"]))]
    sheet = "workbook string, sheet string, row_idx long, values array<string>"
    data = spark.range(3, 40003).select(
        F.lit("w").alias("workbook"), F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("sheet"),
        F.col("id").alias("row_idx"), F.array(F.lit("Carnes"), F.col("id").cast("string"), F.lit("5")).alias("values"))
    grid = spark.createDataFrame(heads, sheet).unionByName(data)
    plain, ranged = publication_records(grid), publication_records(grid, ranges=True)
    assert ranged.columns == plain.columns
    assert ranged.exceptAll(plain).isEmpty() and plain.exceptAll(ranged).isEmpty() and plain.count() == 40000
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        layout = spark.createDataFrame([("w", "hot", 40002, 7), ("w", "small", 40000, 8)],
                                       "workbook string, sheet string, _bottom long, x int")
        joined = join_layout(grid, layout, 256)
        assert joined.count() == grid.count()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < grid.count() / 4
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def _moves(df, column):
    """How many exchanges of the plan carry ``column``."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    import re
    return len(re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\b" + column + "#", text))


def test_sheet_rows_are_shuffled_once(spark, tmp_path, monkeypatch):
    """Finding the layout moves no data rows; the type map and its use move records once."""
    from shelfprice.operators.grid import rows_from_cells
    from shelfprice.plans.exports import publication_records, sales_records
    from shelfprice.session import land
    monkeypatch.setattr("shelfprice.session.shared_folder", lambda s: str(tmp_path))
    rows = [(1, 0, "CLUSTER A"), (1, 3, "CLUSTER B"), (2, 0, "Rubro"), (2, 1, "Tipo"), (2, 2, "Cód."),
            (2, 3, "Rubro"), (2, 4, "Cod"), (2, 5, "sin iva"), (3, 0, "Carnes"), (3, 1, "T1"), (3, 2, "7"),
            (3, 3, "Carnes"), (3, 4, "7"), (3, 5, "20"), (4, 3, "Dira"), (4, 4, "8"), (4, 5, "12.6"),
            (5, 3, "Dira"), (5, 5, "3"), (6, 3, "Otros"), (6, 4, "7"), (6, 5, "3")]
    df = cells(spark, rows)
    grid = land(rows_from_cells(df), "rows")
    for fn in (publication_records, sales_records):
        assert _moves(fn(grid), "values") == 1
    got = publication_export(grid)
    assert _moves(got, "descripcion") <= 1
    # block A has no 'sin iva' column; B takes A's types ('' for an unknown code or none)
    assert sorted((r.cluster, r.row_idx, r.tipo) for r in got.collect()) == \
        [("A", 3, "T1"), ("B", 3, "T1"), ("B", 4, ""), ("B", 5, "")]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, publication_export(df).collect()))


def test_few_sheets_do_not_bound_the_tasks(spark, tmp_path, monkeypatch):
    """Rows and prices of a handful of sheets are not shuffled by sheet or by date column;
    template rows move before they become cells, and dates are parsed once for a column."""
    from shelfprice.operators.grid import cells_from_rows, rows_from_cells
    from shelfprice.session import land
    monkeypatch.setattr("shelfprice.session.shared_folder", lambda s: str(tmp_path))
    lists = spark.createDataFrame([("s", 7)], "list_name string, list_id int")
    history = land(cells(spark, [(3, 3, "1/2/2024"), (3, 6, "junio"), (4, 0, "r"), (4, 1, "12"), (4, 2, "p"),
                                 (4, 3, "10.5"), (4, 6, "3"), (5, 1, "8"), (5, 3, "2")]), "history")
    by_rows = land(rows_from_cells(history), "history-rows")
    want = [(8, "2024-02-01 00:00:00", 2.0), (12, "2024-02-01 00:00:00", 10.5)]
    for grid, n in ((history, 1), (by_rows, 0)):
        got = history_load(grid, lists)
        # cells meet their base columns by row; sheet rows have all they need
        assert _moves(got, "price_value") <= n and _moves(got, "values") == 0
        assert sorted((r.cod_art, str(r.fecha), r.precio) for r in got.collect()) == want
        assert [(r.col_idx, r.reject_reason) for r in history_rejects(grid, lists).collect()] == [(6, "bad_date")]
    template = land(rows_from_cells(cells(spark, [
        (1, 3, "5/1/2024"), (2, 0, "Código"), (2, 1, "Descripción"), (2, 2, "Rubro"), (2, 3, "M"), (2, 4, "N"),
        (3, 0, "7"), (3, 3, "10"), (4, 0, "7"), (4, 3, "11"), (5, 0, "8"), (5, 4, "3")])), "template")
    assert cells_from_rows(template).count() == 12
    got = template_load(template, ["s"], "2024-12-30")
    assert _moves(got, "price_value") == 0 and _moves(got, "precio") == 0 and _moves(got, "competencia") == 0
    assert sorted((r.cod_art, r.competencia, float(r.precio or 0), str(r.fecha_modificacion)) for r in got.collect()) == \
        [(7, "M", 11.0, "2024-01-05"), (7, "N", 0.0, "None"), (8, "M", 0.0, "2024-01-05"), (8, "N", 3.0, "None")]


def _broadcast(plans, column):
    """How many broadcasts of the plans carry ``column``."""
    import re
    return sum(len(re.findall(r"\(\d+\) BroadcastExchange\nInput \[\d+\]: \[[^\]]*\b" + column + "#", p)) for p in plans)


@pytest.mark.parametrize("query", ["publication_export", "sales_export", "rewritten_exports",
                                   "sales_file_manifest", "sales_file_lines"])
def test_layout_does_not_go_through_the_driver(spark, tmp_path, monkeypatch, query):
    """A table with rows for every sheet is never broadcast, however few bytes its file has."""
    from shelfprice.operators.grid import rows_from_cells
    from shelfprice.plans import exports, registry, written
    from shelfprice.session import land
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plans = []

    def spy(df, name):
        plans.append(df._jdf.queryExecution().explainString(mode))
        return land(df, name)
    monkeypatch.setattr("shelfprice.session.shared_folder", lambda s: str(tmp_path))
    grid = land(rows_from_cells(cells(spark, [
        (1, 0, "CLUSTER ALFA"), (1, 3, "CLUSTER B"), (2, 0, "Rubro"), (2, 1, "Cod"), (2, 2, "sin iva"), (2, 3, "Rubro"),
        (2, 4, "Cod"), (2, 5, "sin iva"), (3, 0, "Carnes"), (3, 1, "7"), (3, 2, "20"), (3, 3, "Dira"), (3, 4, "8"),
        (3, 5, "12.6"), (4, 0, "Otros"), (4, 1, "9"), (4, 2, "4")])), "rows")
    for module in (exports, written):
        monkeypatch.setattr(module, "land", spy)
    monkeypatch.setattr(registry, "_cluster_cells", lambda s, d: grid)
    monkeypatch.setattr(written, "target", lambda s, name: str(tmp_path / name))
    got = registry.QUERIES[query](spark, "")
    plans.append(got._jdf.queryExecution().explainString(mode))
    assert _broadcast(plans, "sheet") == 0 and _broadcast(plans, "field") == 1 and len(plans) > 2
    # rewritten_exports writes the group Dira empty the second time; a file of lines has its list code first
    assert got.count() == {"publication_export": 2, "sales_export": 2, "rewritten_exports": 1,
                           "sales_file_manifest": 2, "sales_file_lines": 4}[query]
