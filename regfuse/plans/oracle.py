"""DuckDB SQL text for the oracle side of the correctness check.

These builders return SQL *strings*: the same normalisers written as SQL
expressions, and the stand-in registers as CTEs.  They are used only by
``oracle_sql()`` - the Spark side never runs SQL from here.
"""

from __future__ import annotations

from regfuse.functions.constants import MINISTRY_RULES, MONTH_NAMES, TRANSLIT_FROM, TRANSLIT_TO


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm_name(e: str) -> str:
    x = f"lower(translate(replace({e}, 'ß', 'ss'), {q(TRANSLIT_FROM)}, {q(TRANSLIT_TO)}))"
    x = f"regexp_replace({x}, '[^a-z0-9]+', '_', 'g')"
    return f"regexp_replace({x}, '^_|_$', '', 'g')"


# Unicode White_Space, as Java's (?U)\s sees it
WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def as_text(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def upper_full(e: str) -> str:
    """Upper case with full case mapping of sharp s, as the JVM does."""
    return f"upper(replace({e}, 'ß', 'SS'))"


def norm_rut(e: str) -> str:
    return f"nullif(regexp_replace({e}, '[^0-9]', '', 'g'), '')"


def norm_codigo(e: str) -> str:
    return f"nullif(regexp_replace({as_text(e)}, '\\.0$', ''), '')"


def norm_ministerio(e: str) -> str:
    n = norm_name(as_text(e))
    arms = " ".join(f"WHEN regexp_matches({n}, {q(p)}) THEN {q(label)}" for label, p in MINISTRY_RULES)
    return f"(CASE {arms} ELSE {upper_full(as_text(e))} END)"


def tramo_clean(e: str) -> str:
    return norm_name(f"coalesce({e}, '')")


def _finish(raw_cte: str) -> str:
    """Derived columns and the blank-row filter over a raw register CTE."""
    tc = tramo_clean("tramo")
    return f"""
    SELECT *, {tc} AS tramo_clean,
           contains({tc}, 'ampl') AS es_ampliacion,
           rut || '::' || codigo AS project_key
    FROM {raw_cte}
    WHERE NOT (rut IS NULL AND codigo IS NULL AND empresa IS NULL
               AND ministerio_evaluador IS NULL AND fecha_presentado IS NULL
               AND fecha_recomendado IS NULL AND monto_ui IS NULL)"""


def company_label(e: str) -> str:
    return f"('Customer#' || lpad(CAST({e} AS VARCHAR), 9, '0'))"


def registers_cte() -> str:
    """``pres`` and ``rec`` CTE bodies (without the leading WITH)."""
    return f"""
pres_raw AS (
    SELECT 'orders' AS source_file, '' AS source_path, CAST(NULL AS VARCHAR) AS source_sheet,
           1 AS source_header_row, o_orderkey AS source_row,
           CASE WHEN o_orderstatus <> 'P' THEN {norm_rut('CAST(o_custkey AS VARCHAR)')} END AS rut,
           {norm_codigo('CAST(o_orderkey AS VARCHAR)')} AS codigo,
           nullif({as_text(company_label('o_custkey'))}, '') AS empresa,
           nullif({norm_ministerio('o_orderpriority')}, '') AS ministerio_evaluador,
           CAST(o_orderdate AS DATE) AS fecha_presentado,
           CAST(NULL AS DATE) AS fecha_recomendado,
           CAST(NULL AS VARCHAR) AS regimen,
           nullif({as_text('lower(o_orderstatus)')}, '') AS tramo,
           o_totalprice AS monto_ui,
           o_orderkey AS ord
    FROM orders
),
pres AS ({_finish('pres_raw')}),
rec_raw AS (
    SELECT 'lineitem' AS source_file, '' AS source_path, CAST(l_orderkey AS VARCHAR) AS source_sheet,
           1 AS source_header_row, l_linenumber AS source_row,
           {norm_rut('CAST(o_custkey AS VARCHAR)')} AS rut,
           {norm_codigo('CAST(l_orderkey AS VARCHAR)')} AS codigo,
           nullif({as_text(company_label('o_custkey'))}, '') AS empresa,
           nullif({norm_ministerio('o_orderpriority')}, '') AS ministerio_evaluador,
           CAST(NULL AS DATE) AS fecha_presentado,
           CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS fecha_recomendado,
           nullif({as_text('l_returnflag')}, '') AS regimen,
           nullif({as_text('lower(l_linestatus)')}, '') AS tramo,
           l_extendedprice AS monto_ui,
           l_orderkey AS o1, l_linenumber AS o2, l_partkey AS o3, l_suppkey AS o4, l_extendedprice AS o5
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
),
rec AS ({_finish('rec_raw')})"""


REC_ORDER = "o1, o2, o3, o4, o5"


def _first(col: str, is_text: bool) -> str:
    cond = f"{col} IS NOT NULL" + (f" AND {col} <> ''" if is_text else "")
    return f"first({col} ORDER BY {REC_ORDER}) FILTER (WHERE {cond})"


def linkage_cte() -> str:
    """CTEs ``exact``, ``proj``, ``linked``, ``ronly``, ``u`` (union) and ``auth``: the tiers J4 and J5 as joins."""
    return f"""{registers_cte()},
exact AS (
    SELECT project_key, tramo_clean,
           min(fecha_recomendado) AS fecha_recomendado_exact,
           {_first('regimen', True)} AS regimen_recomendado_exact,
           {_first('monto_ui', False)} AS monto_ui_recomendado_exact,
           {_first('ministerio_evaluador', True)} AS ministerio_recomendado_exact,
           count(*) AS recommended_rows_exact
    FROM rec WHERE project_key IS NOT NULL AND tramo_clean <> ''
    GROUP BY project_key, tramo_clean
),
proj AS (
    SELECT project_key,
           min(fecha_recomendado) AS fecha_recomendado_project,
           {_first('regimen', True)} AS regimen_recomendado_project,
           {_first('monto_ui', False)} AS monto_ui_recomendado_project,
           {_first('ministerio_evaluador', True)} AS ministerio_recomendado_project,
           count(*) AS recommended_rows_project,
           count(DISTINCT nullif(tramo_clean, '')) AS recommended_tramos
    FROM rec WHERE project_key IS NOT NULL
    GROUP BY project_key
),
lp AS (
    SELECT p.*, e.fecha_recomendado_exact, e.regimen_recomendado_exact, e.monto_ui_recomendado_exact,
           e.ministerio_recomendado_exact, e.recommended_rows_exact,
           pr.fecha_recomendado_project, pr.regimen_recomendado_project, pr.monto_ui_recomendado_project,
           pr.ministerio_recomendado_project, pr.recommended_rows_project, pr.recommended_tramos,
           (e.fecha_recomendado_exact IS NULL AND pr.recommended_rows_project = 1) AS fb
    FROM pres p
    LEFT JOIN exact e ON p.project_key = e.project_key AND p.tramo_clean = e.tramo_clean
    LEFT JOIN proj pr ON p.project_key = pr.project_key
),
linked AS (
    SELECT * REPLACE (coalesce(fecha_recomendado_exact, CASE WHEN fb THEN fecha_recomendado_project END) AS fecha_recomendado),
           coalesce(regimen_recomendado_exact, CASE WHEN fb THEN regimen_recomendado_project END) AS regimen_recomendado,
           coalesce(monto_ui_recomendado_exact, CASE WHEN fb THEN monto_ui_recomendado_project END) AS monto_ui_recomendado,
           coalesce(ministerio_recomendado_exact, CASE WHEN fb THEN ministerio_recomendado_project END) AS ministerio_recomendado,
           CASE WHEN fecha_recomendado_exact IS NOT NULL THEN 'rut_codigo_tramo'
                WHEN fb THEN 'rut_codigo_unique'
                WHEN recommended_rows_project IS NOT NULL THEN 'rut_codigo_ambiguous'
                ELSE 'presentado_only' END AS match_method,
           'presentado' AS source
    FROM lp
),
ronly AS (
    SELECT r.*,
           r.fecha_recomendado AS fecha_recomendado_exact, r.regimen AS regimen_recomendado_exact,
           r.monto_ui AS monto_ui_recomendado_exact, r.ministerio_evaluador AS ministerio_recomendado_exact,
           CAST(1 AS BIGINT) AS recommended_rows_exact,
           r.fecha_recomendado AS fecha_recomendado_project, r.regimen AS regimen_recomendado_project,
           r.monto_ui AS monto_ui_recomendado_project, r.ministerio_evaluador AS ministerio_recomendado_project,
           CAST(1 AS BIGINT) AS recommended_rows_project,
           CAST(r.tramo_clean <> '' AS BIGINT) AS recommended_tramos,
           TRUE AS fb,
           r.regimen AS regimen_recomendado, r.monto_ui AS monto_ui_recomendado,
           r.ministerio_evaluador AS ministerio_recomendado,
           'recomendado_only' AS match_method, 'recomendado_only' AS source
    FROM rec r
    WHERE NOT EXISTS (SELECT 1 FROM pres p WHERE p.project_key = r.project_key)
),
u AS (
    SELECT 0 AS branch, ord, NULL AS o1, NULL AS o2, NULL AS o3, NULL AS o4, NULL AS o5,
           source, match_method, rut, codigo, project_key, empresa, ministerio_evaluador,
           ministerio_recomendado, fecha_presentado, fecha_recomendado, regimen, regimen_recomendado,
           tramo, es_ampliacion, monto_ui, monto_ui_recomendado, recommended_rows_exact,
           recommended_rows_project, source_file, source_sheet, source_row
    FROM linked
    UNION ALL
    SELECT 1 AS branch, NULL AS ord, o1, o2, o3, o4, o5,
           source, match_method, rut, codigo, project_key, empresa, ministerio_evaluador,
           ministerio_recomendado, CAST(NULL AS DATE) AS fecha_presentado, fecha_recomendado, regimen,
           regimen_recomendado, tramo, es_ampliacion, monto_ui, monto_ui_recomendado,
           recommended_rows_exact, recommended_rows_project, source_file, source_sheet, source_row
    FROM ronly
),
auth AS (
    SELECT row_number() OVER (ORDER BY branch, ord, {REC_ORDER}) AS project_row_id,
           source, match_method, rut, codigo, project_key, empresa,
           coalesce(ministerio_evaluador, ministerio_recomendado) AS ministerio_evaluador,
           fecha_presentado, fecha_recomendado,
           coalesce(regimen_recomendado, regimen) AS regimen,
           tramo, es_ampliacion,
           monto_ui AS monto_ui_presentado, monto_ui_recomendado,
           CASE WHEN fecha_recomendado IS NOT NULL THEN coalesce(monto_ui_recomendado, monto_ui) END
               AS monto_ui_beneficios,
           fecha_recomendado IS NOT NULL AS has_benefits,
           coalesce(recommended_rows_exact, recommended_rows_project) AS recommended_rows_for_key,
           source_file, source_sheet, CAST(source_row AS BIGINT) AS source_row
    FROM u
)"""


def num_to_text(e: str) -> str:
    return f"regexp_replace(CAST({e} AS VARCHAR), '[.]0$', '')"


_NUM_PAT = {
    "comma": r"^[^-0-9,]*(-?[0-9.]*(?:[,][0-9.]*)?(?:[eE][+-]?[0-9]+)?)",
    "dot": r"^[^-0-9.]*(-?[0-9,]*(?:[.][0-9,]*)?(?:[eE][+-]?[0-9]+)?)",
}


def parse_number(e: str, locale: str) -> str:
    raw = f"nullif(regexp_extract({e}, {q(_NUM_PAT[locale])}, 1), '')"
    if locale == "comma":
        clean = f"replace(replace({raw}, '.', ''), ',', '.')"
    else:
        clean = f"replace({raw}, ',', '')"
    return f"TRY_CAST({clean} AS DOUBLE)"


_DATE_ORDERS = [
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%d/%m/%Y"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "%d/%m/%y"),
    (r"^[0-9]{8}$", "%d%m%Y"),
    (r"^[0-9]{6}$", "%d%m%y"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "%Y/%m/%d"),
    (r"^[0-9]{8}$", "%Y%m%d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%m/%d/%Y"),
    (r"^[0-9]{2}/[0-9]{1,2}/[0-9]{1,2}$", "%y/%m/%d"),
    (r"^[0-9]{6}$", "%y%m%d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "%m/%d/%y"),
    (r"^[0-9]{6}$", "%m%d%y"),
]


def parse_date_text(e: str) -> str:
    t = as_text(e)
    month = f"regexp_extract(lower({t}), '\\b(" + "|".join(n for names in MONTH_NAMES for n in names) + ")\\b', 1)"
    arms = " ".join(f"WHEN {month} IN ({', '.join(map(q, names))}) THEN '/{i}/'" for i, names in enumerate(MONTH_NAMES, 1))
    named = f"(CASE WHEN {month} <> '' THEN replace(lower({t}), {month}, CASE {arms} END) ELSE {t} END)"
    v = f"regexp_replace(regexp_replace({named}, '[^0-9]+', '/', 'g'), '^/+|/+$', '', 'g')"
    v = f"regexp_replace({v}, '^([0-9]+/[0-9]+/[0-9]+)(/[0-9]{{1,2}}){{2,3}}$', '\\1')"
    arms = [f"CASE WHEN regexp_matches({t}, '^[0-9]{{5}}([.][0-9]+)?$') "
            f"THEN DATE '1899-12-30' + CAST(floor(CAST({t} AS DOUBLE)) AS INTEGER) END"]
    for guard, fmt in _DATE_ORDERS:
        arms.append(f"CASE WHEN regexp_matches({v}, {q(guard)}) THEN CAST(try_strptime({v}, {q(fmt)}) AS DATE) END")
    return "coalesce(" + ", ".join(arms) + ")"
