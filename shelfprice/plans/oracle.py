"""Brute-force SQL (DuckDB dialect) for every registered query: the correctness
oracle. Written independently of the Spark plans (window functions and plain
joins instead of ``min_by`` aggregates), over the same stand-in inputs."""

from __future__ import annotations

from collections.abc import Sequence

from shelfprice.sources import standins_sql as S

SEQ = S.SEQ_ORDER

from shelfprice.sources.sql_scalar import NUM_RE, price_from_double, round_exact, to_number, trunc_bigint  # noqa: F401


def _slot_cols(n: int) -> list[str]:
    out = []
    for k in range(n):
        out.append(f"wk_{k}")
        if k < n - 1:
            out.append(f"(wk_{k} - wk_{k + 1}) / NULLIF(wk_{k + 1}, 0) AS pct_{k}")
    return out


def _flag_cols(n: int) -> list[str]:
    dirs = [f"CAST(sign(CAST(printf('%.3f', (wk_{k} - wk_{k + 1}) / NULLIF(wk_{k + 1}, 0) * 100) AS DOUBLE)) AS INTEGER) AS dir_{k}"
            for k in range(n - 1)]
    zeros = [f"COALESCE(wk_{k} IS NOT NULL AND wk_{k + 1} = 0, false) AS prev_zero_{k}"
             for k in range(n - 1)]
    return dirs + zeros


def report_sql(ctes: Sequence[str], src: str, value: str, n: int,
               row_keys: Sequence[str] = ("article",), master_key: str = "article",
               by: Sequence[str] = (), unit_flag: str = "numeric") -> str:
    part_by = ", ".join(by)
    by_sel = "".join(f"{b}, " for b in by)
    by_using = ", ".join([*by, "week"])
    keys_nn = " AND ".join(f"{k} IS NOT NULL" for k in [*by, *row_keys])
    rk = ", ".join(row_keys)
    over_by = f"PARTITION BY {part_by} " if by else ""
    if unit_flag == "numeric":
        flag = f"COALESCE({trunc_bigint(to_number('f.unit'))} = 1, false)"
    else:
        flag = "COALESCE(starts_with(upper(trim(f.unit)), '1-'), false)"
    pivots = ", ".join(f"max(CASE WHEN slot = {k} THEN v END) AS wk_{k}" for k in range(n))
    keep_keys = [k for k in row_keys if k not in ("description", "category", "article_type", "unit")]
    key_sel = ", ".join(f"w.{k}" for k in [*by, *keep_keys])
    master_join = " AND ".join(f"w.{k} = f.{k}" for k in [*by, master_key])
    return f"""{S.with_ctes(*ctes)},
wk_all AS (
  SELECT {by_sel}week, bool_or({value} IS NOT NULL AND {keys_nn}) AS has
  FROM {src} WHERE week IS NOT NULL {''.join(f' AND {b} IS NOT NULL' for b in by)}
  GROUP BY {by_sel}week
),
wk AS (
  SELECT * FROM (SELECT *, row_number() OVER ({over_by}ORDER BY week DESC) AS rn FROM wk_all)
  WHERE rn <= {n}
),
slots AS (
  SELECT {by_sel}week, CAST(dense_rank() OVER ({over_by}ORDER BY week DESC) - 1 AS INTEGER) AS slot
  FROM wk WHERE has
),
r AS (SELECT s.* FROM {src} s JOIN wk USING ({by_using})),
first_row AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join([*by, master_key])} ORDER BY {SEQ}) AS rn1
                 FROM r) WHERE rn1 = 1
),
cells AS (
  SELECT {by_sel}{rk}, slot, round_even({value}, 0) AS v FROM (
    SELECT r.*, slot, row_number() OVER (PARTITION BY {', '.join([*by, *row_keys, 'week'])} ORDER BY {SEQ}) AS rn2
    FROM r JOIN slots USING ({by_using})
    WHERE {value} IS NOT NULL AND {keys_nn}
  ) WHERE rn2 = 1
),
wide AS (SELECT {by_sel}{rk}, {pivots} FROM cells GROUP BY {by_sel}{rk})
SELECT {key_sel}, f.description, f.category, f.article_type, {', '.join(_slot_cols(n))},
       f.unit, {flag} AS single_unit, {', '.join(_flag_cols(n))}
FROM wide w LEFT JOIN first_row f ON {master_join}
"""


def long_sql(ctes: Sequence[str], src: str, value: str, n: int | None,
             row_keys: Sequence[str] = ("article",), by: Sequence[str] = ()) -> str:
    by_sel = "".join(f"{b}, " for b in by)
    over_by = f"PARTITION BY {', '.join(by)} " if by else ""
    keys_nn = " AND ".join(f"{k} IS NOT NULL" for k in [*by, *row_keys])
    limit = f"WHERE rn <= {n}" if n is not None else ""
    rk = ", ".join(row_keys)
    part = ", ".join([*by, *row_keys])
    join_prev = " AND ".join(f"c.{k} = p.{k}" for k in [*by, *row_keys])
    return f"""{S.with_ctes(*ctes)},
wk_all AS (
  SELECT {by_sel}week, bool_or({value} IS NOT NULL AND {keys_nn}) AS has
  FROM {src} WHERE week IS NOT NULL GROUP BY {by_sel}week
),
wk AS (SELECT * FROM (SELECT *, row_number() OVER ({over_by}ORDER BY week DESC) AS rn FROM wk_all) {limit}),
slots AS (
  SELECT {by_sel}week, CAST(dense_rank() OVER ({over_by}ORDER BY week DESC) - 1 AS INTEGER) AS slot
  FROM wk WHERE has
),
cells AS (
  SELECT {by_sel}{rk}, week, slot, round_even({value}, 0) AS value FROM (
    SELECT s.*, slot, row_number() OVER (PARTITION BY {part}, week ORDER BY {SEQ}) AS rn2
    FROM {src} s JOIN slots USING ({', '.join([*by, 'week'])})
    WHERE {value} IS NOT NULL AND {keys_nn}
  ) WHERE rn2 = 1
),
j AS (
  SELECT c.*, p.value AS prev_value, (c.value - p.value) / NULLIF(p.value, 0) AS pct_change
  FROM cells c LEFT JOIN cells p ON {join_prev} AND p.slot = c.slot + 1
)
SELECT {by_sel}{rk}, week, slot, value, prev_value, pct_change,
       COALESCE(printf('%.3f%%', pct_change * 100), '') AS pct_label,
       CAST(sign(CAST(printf('%.3f', pct_change * 100) AS DOUBLE)) AS INTEGER) AS direction,
       COALESCE(prev_value = 0, false) AS prev_is_zero,
       lower(strftime(week, '%d-%b')) AS week_label
FROM j
"""


# --------------------------------------------------- scalar cleaning in SQL

def clean_price(x: str) -> str:
    s1 = f"replace(replace(trim(CAST({x} AS VARCHAR)), '$', ''), ' ', '')"
    s2 = (f"(CASE WHEN contains({s1}, ',') AND contains({s1}, '.') "
          f"THEN replace(replace({s1}, '.', ''), ',', '.') "
          f"WHEN contains({s1}, ',') THEN replace({s1}, ',', '.') ELSE {s1} END)")
    v = f"(CASE WHEN regexp_matches({s2}, '{NUM_RE}') THEN TRY_CAST({s2} AS DOUBLE) END)"
    return price_from_double(v)


def normalise_ratio(x: str) -> str:
    s = f"replace(replace(CAST({x} AS VARCHAR), '%', ''), ',', '.')"
    n = to_number(s)
    return f"(CASE WHEN abs({n}) <= 1 THEN {n} ELSE {n} / 100 END)"


def norm_key(x: str) -> str:
    return f"lower(trim(regexp_replace(COALESCE(CAST({x} AS VARCHAR), ''), '\\s+', ' ', 'g')))"


def safe_name(x: str) -> str:
    return (f"regexp_replace(regexp_replace(trim({x}), '[\\\\/:*?\"<>|]', '_', 'g'), "
            f"'\\s+', ' ', 'g')")


def strip_cluster(x: str, upper: bool = False) -> str:
    s = f"upper({x})" if upper else x
    return f"trim(replace({s}, 'CLUSTER', ''))"


def clean_str(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR lower(trim({x})) = 'nan' THEN '' ELSE trim({x}) END)"


def blank_to_null(x: str) -> str:
    return f"(CASE WHEN trim({x}) <> '' THEN {x} END)"


def code_or_zero(x: str) -> str:
    return f"COALESCE({trunc_bigint(to_number(x))}, 0)"


def code_or_null(x: str) -> str:
    return trunc_bigint(to_number(x))


DATE_FORMATS = tuple(f"{d}{t}" for d in ("%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y-%m-%d", "%Y/%m/%d",
                                         "%d/%m/%y", "%d-%m-%y", "%d.%m.%y")
                     for t in ("", " %H:%M", " %H:%M:%S", " %H:%M:%S.%f", "T%H:%M", "T%H:%M:%S", "T%H:%M:%S.%f"))


def parse_dayfirst(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    return "COALESCE(" + ", ".join(f"try_strptime({t}, '{f}')" for f in DATE_FORMATS) + ")"


# ------------------------------------------------------------- grid oracles

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def block_records_ctes(cells: str, aliases: dict, contains: bool, prefix: str,
                       name_row: int = 1) -> str:
    """CTEs ending in ``{prefix}rec``: one row per block record with the
    canonical fields and has_<field> flags."""
    p = prefix
    match = (f"contains({norm_key('c.value')}, 'rubro')" if contains
             else f"{norm_key('c.value')} = 'rubro'")
    al_rows = ", ".join(f"({_sql_str(f)}, {_sql_str(c)}, {i})"
                        for f, cands in aliases.items() for i, c in enumerate(cands))
    fields = list(aliases)
    pick = ", ".join(f"max(CASE WHEN r.field = {_sql_str(f)} THEN c.value END) AS {f}" for f in fields)
    has = ", ".join(f"COALESCE(bool_or(r.field = {_sql_str(f)}), false) AS has_{f}" for f in fields)
    return f"""
{p}last AS (SELECT workbook, sheet, max(col_idx) AS last_col FROM {cells} GROUP BY 1, 2),
{p}blocks AS (
  SELECT n.workbook, n.sheet, n.col_idx AS block_start,
         COALESCE(lead(n.col_idx) OVER (PARTITION BY n.workbook, n.sheet ORDER BY n.col_idx) - 1,
                  l.last_col) AS block_end,
         trim(n.value) AS block_name
  FROM {cells} n JOIN {p}last l USING (workbook, sheet)
  WHERE n.row_idx = {name_row} AND trim(n.value) <> ''
),
{p}hdr AS (
  SELECT b.*, h.header_row FROM {p}blocks b JOIN (
    SELECT c.workbook, c.sheet, c.col_idx AS block_start, min(c.row_idx) AS header_row
    FROM {cells} c JOIN {p}blocks b
      ON c.workbook = b.workbook AND c.sheet = b.sheet AND c.col_idx = b.block_start
    WHERE c.value IS NOT NULL AND trim(c.value) <> '' AND {match}
    GROUP BY 1, 2, 3) h USING (workbook, sheet, block_start)
),
{p}colmap AS (
  SELECT workbook, sheet, block_start, header_row,
         CAST(unnest(generate_series(block_start, block_end)) AS INTEGER) AS col_idx
  FROM {p}hdr
),
{p}al AS (SELECT DISTINCT field, {norm_key('cand')} AS cand_key, cand_rank
          FROM (VALUES {al_rows}) t(field, cand, cand_rank)),
{p}head AS (
  SELECT c.workbook, c.sheet, m.block_start, c.col_idx, {norm_key('c.value')} AS hkey
  FROM {cells} c JOIN {p}colmap m USING (workbook, sheet, col_idx)
  WHERE c.row_idx = m.header_row
),
{p}resolved AS (
  SELECT workbook, sheet, block_start, field, col_idx FROM (
    SELECT h.*, a.field, row_number() OVER (PARTITION BY h.workbook, h.sheet, h.block_start, a.field
                                             ORDER BY a.cand_rank, h.col_idx DESC) AS rn
    FROM {p}head h JOIN {p}al a ON h.hkey = a.cand_key) WHERE rn = 1
),
{p}recs AS (
  SELECT c.workbook, c.sheet, m.block_start, c.row_idx, {pick}
  FROM {cells} c JOIN {p}colmap m USING (workbook, sheet, col_idx)
  LEFT JOIN {p}resolved r ON r.workbook = c.workbook AND r.sheet = c.sheet
       AND r.block_start = m.block_start AND r.col_idx = c.col_idx
  WHERE c.value IS NOT NULL AND c.row_idx > m.header_row
  GROUP BY 1, 2, 3, 4
),
{p}has AS (
  SELECT h.workbook, h.sheet, h.block_start, h.block_name, {has}
  FROM {p}hdr h LEFT JOIN {p}resolved r USING (workbook, sheet, block_start)
  GROUP BY 1, 2, 3, 4
),
{p}rec AS (SELECT * FROM {p}recs JOIN {p}has USING (workbook, sheet, block_start))"""


def publication_export_sql(prefix: str = "pub_") -> str:
    from shelfprice.plans.exports import PUBLICATION_TABS
    p = prefix
    tabs = ", ".join(f"({_sql_str(t)}, {_sql_str(r)})" for t, r in PUBLICATION_TABS.items())
    v = f"round_even({to_number('sin_iva')}, 0)"
    pr = f"round_even({to_number('precio')}, 0)"
    ratio = normalise_ratio("vs_lista")
    return f""",
{p}src AS (SELECT * FROM {p}rec WHERE has_tipo AND has_codigo AND codigo IS NOT NULL),
{p}fb AS (SELECT workbook, sheet, min(block_start) AS block_start FROM {p}src GROUP BY 1, 2),
{p}tmap AS (SELECT workbook, sheet, codigo, tipo AS map_tipo FROM (
    SELECT s.*, row_number() OVER (PARTITION BY s.workbook, s.sheet, s.codigo ORDER BY s.row_idx) AS rn
    FROM {p}src s JOIN {p}fb USING (workbook, sheet, block_start)) WHERE rn = 1),
{p}enr AS (
  SELECT r.* REPLACE (CASE WHEN NOT r.has_tipo AND r.has_codigo AND fb.block_start IS NOT NULL
                           THEN COALESCE(t.map_tipo, '') ELSE r.tipo END AS tipo)
  FROM {p}rec r LEFT JOIN {p}tmap t USING (workbook, sheet, codigo)
  LEFT JOIN {p}fb fb ON fb.workbook = r.workbook AND fb.sheet = r.sheet
),
{p}out AS (
  SELECT e.*, tabs.tab, tabs.tab_rubro FROM {p}enr e CROSS JOIN (VALUES {tabs}) tabs(tab, tab_rubro)
  WHERE (NOT e.has_rubro OR e.rubro = tabs.tab_rubro)
    AND (NOT e.has_sin_iva OR ({v} IS NOT NULL AND {v} <> 0))
)
SELECT {safe_name(strip_cluster('block_name'))} AS cluster, tab, workbook, sheet, block_start, row_idx,
       rubro, tipo, codigo, descripcion,
       TRY_CAST({v} AS BIGINT) AS sin_iva, TRY_CAST({pr} AS BIGINT) AS precio,
       {ratio} AS vs_lista, unidad_me,
       COALESCE(abs(TRY_CAST({v} AS BIGINT)) % 100 = 99, false) AS sin_iva_ends_99,
       COALESCE(abs(TRY_CAST({pr} AS BIGINT)) % 100 = 99, false) AS precio_ends_99,
       CAST(sign({ratio}) AS INTEGER) AS vs_sign
FROM {p}out"""


def sales_export_ctes(list_codes: dict, date_text: str, prefix: str = "sal_") -> str:
    from shelfprice.plans.exports import SALES_CATEGORIES
    p = prefix
    cats = ", ".join(f"({_sql_str(c)}, {_sql_str(v)})" for c, v in SALES_CATEGORIES.items())
    codes = ", ".join(f"({_sql_str(k)}, {_sql_str(v)})" for k, v in list_codes.items())
    price = to_number("sin_iva")
    cluster = safe_name(strip_cluster("trim(block_name)"))
    return f""",
{p}base AS (
  SELECT r.*, upper(trim(COALESCE(rubro, 'None'))) AS rub_u, {price} AS price_v, {cluster} AS cluster
  FROM {p}rec r WHERE has_rubro AND has_codigo AND has_sin_iva
),
{p}export AS (
  SELECT b.cluster, c.category, COALESCE(k.list_code, '') AS list_code, b.workbook, b.sheet,
         b.block_start, b.row_idx, b.codigo, b.price_v AS precio, CAST(0.0 AS DOUBLE) AS cero,
         {_sql_str(date_text)} AS fecha_texto
  FROM {p}base b JOIN (VALUES {cats}) c(category, cat_value) ON b.rub_u = c.cat_value
  LEFT JOIN (VALUES {codes}) k(code_key, list_code) ON {strip_cluster('b.cluster', upper=True)} = k.code_key
  WHERE b.price_v IS NOT NULL AND b.price_v <> 0
)"""


def history_parsed_ctes(cells: str = "history_cells") -> str:
    return f""",
hp_prices AS (SELECT workbook, sheet, row_idx, col_idx, value AS price_value FROM {cells}
              WHERE row_idx >= 4 AND col_idx >= 3 AND (col_idx - 3) % 3 = 0 AND value IS NOT NULL),
hp_dates AS (SELECT workbook, sheet, col_idx, value AS date_value FROM {cells}
             WHERE row_idx = 3 AND col_idx >= 3 AND (col_idx - 3) % 3 = 0),
hp_base AS (SELECT workbook, sheet, row_idx,
                   max(CASE WHEN col_idx = 0 THEN value END) AS rubro,
                   max(CASE WHEN col_idx = 1 THEN value END) AS cod_text,
                   max(CASE WHEN col_idx = 2 THEN value END) AS producto
            FROM {cells} WHERE row_idx >= 4 AND col_idx < 3 GROUP BY 1, 2, 3),
hp_raw AS (SELECT p.*, d.date_value, b.rubro, b.cod_text, b.producto
           FROM hp_prices p LEFT JOIN hp_dates d USING (workbook, sheet, col_idx)
           LEFT JOIN hp_base b USING (workbook, sheet, row_idx)),
hp_tagged AS (
  SELECT *, CASE WHEN _precio IS NULL THEN 'no_price'
                 WHEN _code IS NULL AND producto IS NULL THEN 'no_code_no_product'
                 WHEN _fecha IS NULL THEN 'bad_date' END AS reject_reason
  FROM (SELECT *, {to_number('price_value')} AS _precio,
               date_trunc('minute', {parse_dayfirst('date_value')}) AS _fecha,
               {blank_to_null('cod_text')} AS _code FROM hp_raw)
)"""


def template_load_ctes(sheets, as_of: str, cells: str = "template_cells") -> str:
    order = ", ".join(f"({_sql_str(s)}, {i})" for i, s in enumerate(sheets))
    return f""",
tl_ord(sheet, sheet_rank) AS (VALUES {order}),
tl_sc AS (SELECT c.* FROM {cells} c JOIN tl_ord USING (sheet)),
tl_cc AS (SELECT workbook, sheet, min(col_idx) AS code_col FROM tl_sc
          WHERE row_idx = 2 AND trim(value) = 'Código' GROUP BY 1, 2),
tl_codes AS (SELECT c.workbook, c.sheet, c.row_idx, {code_or_null('c.value')} AS cod_art FROM tl_sc c
             JOIN tl_cc k ON k.workbook = c.workbook AND k.sheet = c.sheet AND k.code_col = c.col_idx
             WHERE c.row_idx >= 3 AND {code_or_null('c.value')} IS NOT NULL),
tl_vals AS (SELECT v.workbook, v.sheet, v.row_idx, v.col_idx, CASE WHEN trim(v.value) <> '' THEN v.value END AS price_value, k.cod_art
            FROM tl_sc v JOIN tl_codes k USING (workbook, sheet, row_idx) JOIN tl_cc c USING (workbook, sheet)
            WHERE v.row_idx >= 3 AND v.col_idx >= 3 AND v.col_idx <> c.code_col),
tl_top AS (SELECT workbook, sheet, col_idx, trim(value) AS h, value AS raw,
                  row_number() OVER (PARTITION BY workbook, sheet, value ORDER BY col_idx) AS nth
           FROM tl_sc WHERE row_idx = 2 AND trim(value) <> ''),
tl_heads AS (SELECT c.workbook, c.sheet, c.col_idx,
                    CASE WHEN t.h IS NULL THEN 'Unnamed: ' || c.col_idx WHEN t.nth > 1 THEN t.raw || '.' || (t.nth - 1)
                         WHEN t.h = 'Descripción' THEN 'descripcion' ELSE t.raw END AS competencia
             FROM (SELECT DISTINCT workbook, sheet, col_idx FROM tl_vals) c
             LEFT JOIN tl_top t USING (workbook, sheet, col_idx)),
tl_above AS (SELECT t.workbook, t.sheet, t.h, arg_max(d.value, d.col_idx) AS date_text
             FROM tl_top t JOIN tl_sc d USING (workbook, sheet, col_idx)
             WHERE d.row_idx = 1 AND trim(d.value) <> '' AND t.h NOT IN ('Código', 'Descripción') GROUP BY 1, 2, 3),
tl_dates AS (SELECT h.workbook, h.sheet, h.col_idx, CAST({parse_dayfirst('a.date_text')} AS DATE) AS fecha_modificacion
             FROM tl_heads h JOIN tl_above a ON a.workbook = h.workbook AND a.sheet = h.sheet AND a.h = trim(h.competencia)),
tl_filled AS (SELECT DISTINCT workbook, sheet, col_idx FROM tl_vals WHERE price_value IS NOT NULL),
tl_rows AS (
  SELECT v.cod_art, v.sheet AS cluster, h.competencia, {clean_price('v.price_value')} AS precio,
         CAST(year(DATE '{as_of}') AS INTEGER) AS anio, CAST(weekofyear(DATE '{as_of}') AS INTEGER) AS semana,
         d.fecha_modificacion, o.sheet_rank, v.col_idx, v.row_idx
  FROM tl_vals v JOIN tl_filled USING (workbook, sheet, col_idx)
  JOIN tl_heads h USING (workbook, sheet, col_idx)
  LEFT JOIN tl_dates d USING (workbook, sheet, col_idx)
  JOIN tl_ord o ON o.sheet = v.sheet
),
tl_final AS (
  SELECT cod_art, cluster, competencia, precio, anio, semana, fecha_modificacion FROM (
    SELECT *, row_number() OVER (PARTITION BY cod_art, cluster, competencia, anio, semana
                                 ORDER BY sheet_rank DESC, col_idx DESC, row_idx DESC) AS rn
    FROM tl_rows) WHERE rn = 1
)"""
