"""The grid stand-ins of ``grid_standins`` as SQL (DuckDB) for the oracle."""

from __future__ import annotations

from shelfprice.sources.grid_standins import (CLUSTER_FIRST_DATA_ROW, CLUSTER_LAYOUT,
                                              CLUSTER_NAME_ROW, CLUSTER_NAMES)
from shelfprice.sources.standins_sql import SEQ_ORDER


def _cents_text(c: str) -> str:
    return f"(CAST(({c}) // 100 AS VARCHAR) || '.' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))"


def _thousands_text(c: str) -> str:
    u = f"(({c}) // 100)"
    return (f"('$ ' || CASE WHEN {u} >= 1000 THEN CAST({u} // 1000 AS VARCHAR) || '.' || "
            f"lpad(CAST({u} % 1000 AS VARCHAR), 3, '0') ELSE CAST({u} AS VARCHAR) END || ',' || "
            f"lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))")


_VALUES = {
    "rubro": ("CASE p_type WHEN 'ECONOMY' THEN 'Carnes' WHEN 'LARGE' THEN 'Fiambres' "
              "WHEN 'MEDIUM' THEN 'Reventa' WHEN 'PROMO' THEN 'Dira' WHEN 'SMALL' THEN ' carnes ' "
              "ELSE 'Otros' END"),
    "tipo": "p_brand",
    "cod": "CAST(p_partkey AS VARCHAR)",
    "desc": "p_name",
    "siniva": ("CASE WHEN p_size = 1 THEN '0' WHEN p_size = 2 THEN 'n/d' WHEN p_size = 3 THEN '0.4' "
               f"ELSE {_cents_text('cents')} END"),
    "precio": _cents_text("(cents * 121) // 100"),
    "vs": "CAST(p_size - 25 AS VARCHAR) || ',5%'",
    "unidad": "CAST(p_size AS VARCHAR)",
    "notas": "p_type",
}


def _cluster_sheet() -> str:
    parts = []
    for col, _hr, _h, key in CLUSTER_LAYOUT:
        cond = "TRUE"
        if col == 6:
            cond = "p_size <= 45"
        if 15 <= col <= 18:
            cond = "p_size <= 40"
        parts.append(f"SELECT 'clusters' AS workbook, s_name AS sheet, "
                     f"CAST(p_partkey + {CLUSTER_FIRST_DATA_ROW} AS BIGINT) AS row_idx, "
                     f"CAST({col} AS INTEGER) AS col_idx, CASE WHEN {cond} THEN {_VALUES[key]} END AS value "
                     f"FROM cs_base")
    for col, hr, h, _k in CLUSTER_LAYOUT:
        text = (f"'{h}'" if h is not None else
                "CASE WHEN s_nationkey >= 20 THEN 'Grupo' ELSE ' rubro' END")
        parts.append(f"SELECT 'clusters', s_name, CAST({hr} AS BIGINT), CAST({col} AS INTEGER), {text} "
                     f"FROM cs_sheets")
    for col, name in CLUSTER_NAMES:
        parts.append(f"SELECT 'clusters', s_name, CAST({CLUSTER_NAME_ROW} AS BIGINT), "
                     f"CAST({col} AS INTEGER), '{name}' FROM cs_sheets")
    union = "\n  UNION ALL ".join(parts)
    return f"""
cs_pairs AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
cs_base AS (SELECT s_name, s_nationkey, p.*, CAST(round(p_retailprice * 100) AS BIGINT) AS cents
            FROM cs_pairs JOIN supplier ON l_suppkey = s_suppkey JOIN part p ON l_partkey = p_partkey),
cs_sheets AS (SELECT s_name, s_nationkey FROM supplier
              WHERE s_suppkey IN (SELECT l_suppkey FROM cs_pairs)),
cluster_cells AS (SELECT * FROM (
  {union}) WHERE value IS NOT NULL)"""


CLUSTER_CELLS = _cluster_sheet()

# needs PRICE_LISTS and LINE_CUSTOMER
HISTORY_CELLS = f"""
hs_first AS (
  SELECT sheet, p_partkey, k, month, l_extendedprice, l_returnflag, l_linestatus, l_linenumber FROM (
    SELECT c_mktsegment AS sheet, p_partkey,
           CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS k,
           min(date_trunc('month', l_shipdate)) OVER (PARTITION BY c_mktsegment, p_partkey,
               (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1) AS month,
           l_extendedprice, l_returnflag, l_linestatus, l_linenumber,
           row_number() OVER (PARTITION BY c_mktsegment, p_partkey,
               (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 ORDER BY {SEQ_ORDER}) AS rn
    FROM line_customer JOIN part ON l_partkey = p_partkey) WHERE rn = 1
),
hs_rows AS (SELECT DISTINCT sheet, p_partkey FROM hs_first),
history_cells AS (
  SELECT 'history' AS workbook, sheet, CAST(p_partkey + 4 AS BIGINT) AS row_idx,
         CAST(k * 3 + 3 AS INTEGER) AS col_idx,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 's/p'
              WHEN l_linenumber = 7 THEN '0'
              ELSE {_cents_text('CAST(round(l_extendedprice * 100) AS BIGINT)')} END AS value
  FROM hs_first
  UNION ALL
  SELECT 'history', sheet, CAST(p_partkey + 4 AS BIGINT), CAST(k * 3 + 4 AS INTEGER),
         CAST(l_linenumber AS VARCHAR) FROM hs_first
  UNION ALL
  SELECT DISTINCT 'history', sheet, CAST(3 AS BIGINT), CAST(k * 3 + 3 AS INTEGER),
         CASE WHEN month(month) = 6 THEN 'junio' ELSE strftime(month, '%-d/%-m/%Y') END FROM hs_first
  UNION ALL
  SELECT 'history', sheet, CAST(p_partkey + 4 AS BIGINT), 0, p_type FROM hs_rows JOIN part USING (p_partkey)
  UNION ALL
  SELECT 'history', sheet, CAST(p_partkey + 4 AS BIGINT), 1,
         CASE WHEN p_size = 7 THEN 'X' || CAST(p_partkey AS VARCHAR) WHEN p_size = 8 THEN ''
              ELSE CAST(p_partkey AS VARCHAR) END
  FROM hs_rows JOIN part USING (p_partkey)
  UNION ALL
  SELECT 'history', sheet, CAST(p_partkey + 4 AS BIGINT), 2,
         CASE WHEN p_size = 8 AND p_brand = 'Brand#1' THEN NULL ELSE p_name END
  FROM hs_rows JOIN part USING (p_partkey)
  UNION ALL
  SELECT 'history', list_name, CAST(0 AS BIGINT), 0, 'Lista de precios' FROM price_lists
)"""

# needs LINE_CUSTOMER; every cell of the grid is there, blank ones with a null value
TEMPLATE_CELLS = f"""
tp_first AS (
  SELECT sheet, p_partkey, s_nationkey, l_extendedprice, l_linenumber, last_order FROM (
    SELECT r_name AS sheet, p_partkey, s_nationkey, l_extendedprice, l_linenumber,
           max(o_orderdate) OVER (PARTITION BY r_name, p_partkey, s_nationkey) AS last_order,
           row_number() OVER (PARTITION BY r_name, p_partkey, s_nationkey ORDER BY {SEQ_ORDER}) AS rn
    FROM line_customer JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey) WHERE rn = 1
),
tp_comp AS (
  SELECT sheet, s_nationkey, max(last_order) AS last_order, n_name
  FROM tp_first JOIN nation ON s_nationkey = n_nationkey GROUP BY sheet, s_nationkey, n_name
),
tp_rows AS (SELECT DISTINCT sheet, p_partkey FROM tp_first),
tp_text AS (
  SELECT sheet, p_partkey, s_nationkey,
         CASE WHEN l_linenumber = 2 THEN {_thousands_text('CAST(round(l_extendedprice * 100) AS BIGINT)')}
              WHEN l_linenumber = 3 THEN replace({_cents_text('CAST(round(l_extendedprice * 100) AS BIGINT)')}, '.', ',')
              WHEN l_linenumber = 4 THEN NULL
              ELSE {_cents_text('CAST(round(l_extendedprice * 100) AS BIGINT)')} END AS value
  FROM tp_first
),
template_cells AS (
  SELECT 'template' AS workbook, r.sheet, CAST(r.p_partkey + 3 AS BIGINT) AS row_idx,
         CAST(n_nationkey + 3 AS INTEGER) AS col_idx, t.value
  FROM tp_rows r CROSS JOIN nation n
  LEFT JOIN tp_text t ON t.sheet = r.sheet AND t.p_partkey = r.p_partkey AND t.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT 'template', sheet, CAST(2 AS BIGINT), CAST(s_nationkey + 3 AS INTEGER),
         CASE WHEN sheet = 'EUROPE' AND s_nationkey = 24 THEN 'Descripción'
              WHEN sheet = 'AFRICA' AND s_nationkey = 23 THEN NULL
              WHEN sheet = 'AMERICA' AND s_nationkey IN (1, 4, 7) THEN 'MARKET' ELSE n_name END FROM tp_comp
  UNION ALL
  SELECT DISTINCT 'template', sheet, CAST(2 AS BIGINT), CASE WHEN sheet = 'ASIA' THEN 2 ELSE 1 END, 'Descripción' FROM tp_rows
  UNION ALL
  SELECT DISTINCT 'template', sheet, CAST(2 AS BIGINT), CASE WHEN sheet = 'ASIA' THEN 0 ELSE 2 END, 'Rubro' FROM tp_rows
  UNION ALL
  SELECT 'template', sheet, CAST(1 AS BIGINT), CAST(s_nationkey + 3 AS INTEGER),
         CASE WHEN s_nationkey = 0 THEN 'sin fecha' ELSE strftime(last_order, '%-d/%-m/%Y') END FROM tp_comp
  UNION ALL
  SELECT 'template', sheet, CAST(p_partkey + 3 AS BIGINT), CASE WHEN sheet = 'ASIA' THEN 1 ELSE 0 END,
         CASE WHEN p_size = 7 THEN 'N/A' WHEN p_size = 9 THEN CAST(p_partkey - 1 AS VARCHAR) || '.5'
              ELSE CAST(p_partkey AS VARCHAR) END
  FROM tp_rows JOIN part USING (p_partkey)
  UNION ALL
  SELECT DISTINCT 'template', sheet, CAST(2 AS BIGINT), CASE WHEN sheet = 'ASIA' THEN 1 ELSE 0 END, 'Código' FROM tp_rows
)"""
