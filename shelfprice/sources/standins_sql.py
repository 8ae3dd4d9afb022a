"""The stand-in inputs of ``shelfprice.sources.standins`` written as SQL common
table expressions for the DuckDB oracle (tables ``lineitem``, ``part``, … are
views over the same Parquet files). Keep the two modules in step.
"""

from __future__ import annotations

SEQ_ORDER = ("l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
             "l_quantity, l_extendedprice, l_discount")

WEEKLY_ROWS = f"""
weekly_rows AS (
  SELECT p_brand || '|' || p_type AS article, p_name AS description,
         p_brand AS category, p_type AS article_type, p_size AS unit,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
         l_extendedprice / l_quantity AS cost,
         l_extendedprice * (1 - l_discount) / l_quantity AS commercial_cost,
         {SEQ_ORDER}
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

PRICE_LISTS = """
price_lists AS (
  SELECT CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS list_id,
         c_mktsegment AS list_name
  FROM (SELECT DISTINCT c_mktsegment FROM customer)
)"""

LINE_CUSTOMER = """
line_customer AS (
  SELECT l.*, o_orderdate, c_mktsegment, r_name
  FROM lineitem l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

WEEKLY_PRICE_ROWS = f"""
weekly_price_rows AS (
  SELECT list_id, p_brand || '|' || p_type AS article, p_name AS description,
         p_brand AS category, p_type AS article_type,
         CAST(p_size AS VARCHAR) || '-' || p_type AS unit,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
         l_extendedprice * (1 + l_tax) / l_quantity AS price,
         {SEQ_ORDER}
  FROM line_customer JOIN part ON l_partkey = p_partkey
  JOIN price_lists ON c_mktsegment = list_name
)"""

COMPETITOR_ROWS = f"""
competitor_rows AS (
  SELECT l_partkey AS cod_art, p_name AS description, p_brand AS category,
         p_type AS article_type, r_name AS cluster, s_name AS competitor,
         CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
         l_extendedprice / l_quantity AS price,
         CAST(o_orderdate AS DATE) AS modified_on,
         {SEQ_ORDER}
  FROM line_customer JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

# decimal(18,4) price: 0 → null; half-even to 4 places on the exact value
def _price(v: str) -> str:
    from shelfprice.sources.sql_scalar import price_from_double
    return price_from_double(v)


COMPETITOR_FACT_ROWS = f"""
competitor_fact_rows AS (
  SELECT cod_art, cluster, competitor AS competencia,
         {_price('price')} AS precio,
         CAST(year(l_shipdate) AS INTEGER) AS anio,
         CAST(weekofyear(l_shipdate) AS INTEGER) AS semana,
         modified_on AS fecha_modificacion,
         {SEQ_ORDER}
  FROM competitor_rows
)"""

HISTORY_ROWS = f"""
history_rows AS (
  SELECT 'excel' AS origen, list_id AS id_lista, list_name AS lista,
         date_trunc('minute', l_shipdate) AS fecha, 0 AS product_id,
         l_partkey AS cod_art, p_name AS producto,
         l_extendedprice / l_quantity AS precio,
         '' AS uom, '' AS unidad_me, '' AS invoicing_type,
         CAST(0.0 AS DOUBLE) AS contenido, CAST(0.0 AS DOUBLE) AS box_kgs,
         l_discount AS precioxkg,
         date_trunc('minute', l_shipdate) + l_linenumber * INTERVAL 1 MINUTE AS ing_hora,
         {SEQ_ORDER}
  FROM line_customer JOIN part ON l_partkey = p_partkey
  JOIN price_lists ON c_mktsegment = list_name
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PLAIN = "CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')"
THOUSANDS = ("'$ ' || CASE WHEN cents // 100 >= 1000 THEN CAST(cents // 100000 AS VARCHAR) || '.' || "
             "lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0') ELSE CAST(cents // 100 AS VARCHAR) END"
             " || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')")

PRICE_TEXT_ROWS = f"""
price_text_rows AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
    CASE l_linenumber
      WHEN 1 THEN {PLAIN}
      WHEN 2 THEN replace({PLAIN}, '.', ',')
      WHEN 3 THEN {THOUSANDS}
      WHEN 4 THEN ' $' || {PLAIN} || ' '
      WHEN 5 THEN CAST(cents // 100000 AS VARCHAR) || '.' || lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0')
      WHEN 6 THEN CASE l_returnflag WHEN 'R' THEN '0' WHEN 'A' THEN '' ELSE 's/p' END
      ELSE {PLAIN} || 'e1' END AS price_text
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
)"""

RATIO_TEXT_ROWS = """
ratio_text_rows AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_linenumber
      WHEN 1 THEN CAST(t // 10 AS VARCHAR) || ',' || CAST(t % 10 AS VARCHAR) || '%'
      WHEN 2 THEN '0.' || lpad(CAST(t AS VARCHAR), 3, '0')
      WHEN 3 THEN '-' || CAST(t // 10 AS VARCHAR)
      WHEN 4 THEN 'abc'
      WHEN 5 THEN CAST(t // 10 AS VARCHAR) || '.5%'
      WHEN 6 THEN '0.5%' END AS ratio_text
  FROM (SELECT *, CAST(round(l_discount * 1000) AS BIGINT) AS t FROM lineitem)
)"""

KEY_TEXT_ROWS = """
key_text_rows AS (
  SELECT p_partkey,
    CASE p_type
      WHEN 'ECONOMY' THEN '  ' || upper(p_name) || '  '
      WHEN 'LARGE' THEN p_name || ' / CLUSTER: ' || p_brand
      WHEN 'MEDIUM' THEN 'nan'
      WHEN 'PROMO' THEN ''
      WHEN 'STANDARD' THEN 'Mayoristas   CLUSTER  ' || p_name || '?' END AS key_text,
    CASE WHEN p_size <= 10 THEN CAST(p_partkey AS VARCHAR) || '.7'
         WHEN p_size <= 20 THEN 'X' || CAST(p_partkey AS VARCHAR)
         WHEN p_size <= 30 THEN ''
         WHEN p_size <= 40 THEN ' ' || CAST(p_partkey AS VARCHAR) || ' '
         ELSE CAST(p_partkey AS VARCHAR) END AS code_text
  FROM part
)"""

DATE_TEXT_ROWS = """
date_text_rows AS (
  SELECT o_orderkey,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN strftime(o_orderdate, '%-d/%-m/%Y')
      WHEN '2-HIGH' THEN strftime(ts, '%-d/%-m/%Y %-H:%M')
      WHEN '3-MEDIUM' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%d/%m/%Y')
      ELSE '31/2/' || CAST(year(o_orderdate) AS VARCHAR) END AS date_text
  FROM (SELECT *, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
               + to_minutes(CAST(o_orderkey % 60 AS INTEGER))
               + to_seconds(CAST(o_orderkey % 60 AS INTEGER)) AS ts FROM orders)
)"""

LIST_TEXT_ROWS = """
list_text_rows AS (
  SELECT c_custkey, c_name || '; ' || c_mktsegment || ',,' ||
         CASE WHEN c_acctbal < 0 THEN ' ' ELSE ' x@y.com ' END AS list_text
  FROM customer
)"""
