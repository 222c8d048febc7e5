"""Workbook rows synthesised from ``orders`` (for header-inference queries).

Orders are dealt into workbooks of ``BOOK_ROWS`` order keys and one priority each; a priority that is missing or not
listed has a layout of its own.  Every layout has its header wording, column order, header position, extra sheets, decoy
columns and cell types (dates as date cells, serials or text; amounts as numbers or comma-decimal text).  All orders become
data rows, in one scan; the few title and header rows are layout configuration, repeated for every workbook that there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.functions.constants import COLUMN_ALIASES, DATASET_EXCLUDED_FIELD, MIN_HEADER_SCORE, PREVIEW_ROWS
from regfuse.operators.headers import ROWS_SCHEMA
from regfuse.plans import oracle as O
from regfuse.plans.standins import table

BOOK_ROWS = 1_000_000  # order keys a workbook; a sheet has 2**20 rows at most
OTHER = "other"

# --- fixed values: synthetic layouts, one per order priority ---
# (label, field or None for a decoy column, cell kind)
LAYOUTS = {
    "1-URGENT": {
        "path": "presentados_urgentes.xlsx", "dataset": "presentados", "sheet": "Datos",
        "sheet_idx": 1, "header_row": 1, "titles": {}, "extra_sheets": [],
        "columns": [
            ("RUT", "rut", "rut_text"), ("Código", "codigo", "code_num"),
            ("Razón Social", "empresa", "company"), ("Ministerio", "ministerio_evaluador", "priority"),
            ("Fecha de Presentación", "fecha_presentado", "date_cell"), ("Régimen", "regimen", "status"),
            ("Tramo", "tramo", "tramo"), ("Monto UI", "monto_ui", "amount_num"),
        ],
    },
    "2-HIGH": {
        "path": "sub/Registro PRESENTADOS alta.xlsm", "dataset": "presentados", "sheet": "Datos",
        "sheet_idx": 2, "header_row": 4, "titles": {1: ["Registro de proyectos"], 2: ["Proyectos presentados"]},
        "extra_sheets": [("Resumen", 1, {1: ["Resumen anual"], 2: ["Empresa", "Total"]})],
        "columns": [
            ("Monto en UI", "monto_ui", "amount_comma"), ("Expediente", "codigo", "code_text"),
            ("Nro RUT", "rut", "rut_text"), ("Organismo", "ministerio_evaluador", "priority"),
            ("Fecha", "fecha_presentado", "date_serial"), ("Fecha", None, "decoy_date"),
            ("Decreto", "regimen", "status"), ("Etapa", "tramo", "tramo"), ("Empresa", "empresa", "company"),
        ],
    },
    "3-MEDIUM": {
        "path": "presentados_media.xlsx", "dataset": "presentados", "sheet": "Hoja1",
        "sheet_idx": 1, "header_row": 9, "titles": {1: ["Listado"], 3: ["Nota: cifras en UI"], 5: ["Fuente", "Comisión"]},
        "extra_sheets": [],
        "columns": [
            ("Documento", "rut", "rut_text"), ("Carpeta", "codigo", "code_num"),
            ("Denominación", "empresa", "company"), ("Inciso", "ministerio_evaluador", "priority"),
            ("Fecha Ingreso", "fecha_presentado", "date_text"), ("Normativa", "regimen", "status"),
            ("Tipo Tramo", "tramo", "tramo"), ("Inversión UI", "monto_ui", "amount_num"),
            ("Observaciones", None, "decoy_text"),
        ],
    },
    "4-NOT SPECIFIED": {
        "path": "recomendados_sin_prioridad.xlsx", "dataset": "recomendados", "sheet": "Recomendados",
        "sheet_idx": 1, "header_row": 4, "titles": {2: ["Proyectos recomendados"]}, "extra_sheets": [],
        "columns": [
            ("R.U.T.", "rut", "rut_text"), ("Cód. Expediente", "codigo", "code_num"),
            ("Titular", "empresa", "company"), ("Ministerio Evaluador", "ministerio_evaluador", "priority"),
            ("Fecha Resolución", "fecha_recomendado", "date_cell"), ("Marco Normativo", "regimen", "status"),
            ("Ampliación", "tramo", "tramo"), ("Monto Inversión UI", "monto_ui", "amount_num"),
        ],
    },
    "5-LOW": {
        "path": "PRESENTADOS_bajas.xlsx", "dataset": "presentados", "sheet": "Datos",
        "sheet_idx": 2, "header_row": 1, "titles": {},
        "extra_sheets": [("Notas", 1, {1: ["Empresa", "Monto"], 2: ["ver hoja Datos"]})],
        "columns": [
            ("Fecha Presentado", "fecha_presentado", "date_text"), ("Empresa", "empresa", "company"),
            ("RUT", "rut", "rut_text"), ("Codigo", "codigo", "code_num"),
            ("Ministerio", "ministerio_evaluador", "priority"), ("Regimen", "regimen", "status"),
            ("Tramo", "tramo", "tramo"), ("UI", "monto_ui", "amount_num"),
        ],
    },
    OTHER: {
        "path": "Recomendados otros.xlsx", "dataset": "recomendados", "sheet": "Hoja1",
        "sheet_idx": 1, "header_row": 3, "titles": {1: ["Recomendados"]}, "extra_sheets": [],
        "columns": [
            ("Nro. Expediente", "codigo", "code_text"), ("Número RUT", "rut", "rut_text"),
            ("Evaluador", "ministerio_evaluador", "priority"), ("Fecha Aprobación", "fecha_recomendado", "date_serial"),
            ("Nombre Empresa", "empresa", "company"), ("Monto UI Total", "monto_ui", "amount_comma"),
        ],
    },
}


def _cell(kind: str, text="NULL", num="NULL", ts="NULL") -> str:
    return (f"named_struct('cell_type', '{kind}', 'text', CAST({text} AS STRING), 'num', CAST({num} AS DOUBLE), "
            f"'ts', CAST({ts} AS TIMESTAMP_NTZ))")


# Cell of each kind of synthetic value, as Spark SQL (a NULL text stands for an empty cell; every reader skips it)
_CELLS = {
    "rut_text": _cell("text", "concat(lpad(CAST(o_custkey AS STRING), 9, '0'), '-', CAST(o_custkey % 10 AS STRING))"),
    "code_num": _cell("number", num="o_orderkey"),
    "code_text": _cell("text", "concat(' ', CAST(o_orderkey AS STRING), ' ')"),
    "company": _cell("text", "concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0'))"),
    "priority": _cell("text", "o_orderpriority"),
    "date_cell": _cell("date", ts="o_orderdate"),
    "date_serial": _cell("number", num="datediff(to_date(o_orderdate), DATE'1899-12-30')"),
    "date_text": _cell("text", "date_format(o_orderdate, 'd/M/yyyy')"),
    "status": _cell("text", "o_orderstatus"),
    "tramo": _cell("text", "CASE o_orderstatus WHEN 'O' THEN 'Inicial' WHEN 'F' THEN '1a. Ampliación' END"),
    "amount_num": _cell("number", num="o_totalprice"),
    "amount_comma": _cell("text", "concat('U$S ', translate(format_number(o_totalprice, 2), ',.', '.,'))"),
    "decoy_text": _cell("text", "concat('obs ', CAST(o_orderkey AS STRING))"),
    "decoy_date": _cell("date", ts="date_add(to_date(o_orderdate), 30)"),
}


def _data_cells(layout) -> str:
    keys = ", ".join(str(i) for i in range(1, len(layout["columns"]) + 1))
    cells = ", ".join(_CELLS[kind] for _, _, kind in layout["columns"])
    # in a lambda: six layouts exceed the size of generated code
    return f"transform(array(0), x -> map_from_arrays(array({keys}), array({cells})))[0]"


def _by_layout(value) -> Column:
    """``value`` (layout -> SQL) of each row's layout."""
    return F.expr("CASE layout " + " ".join(f"WHEN {O.q(name)} THEN {value(lay)}" for name, lay in LAYOUTS.items()) + " END")


def _orders(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Orders with their layout and the number of their workbook."""
    o = table(spark, sf_dir, "orders", list(dict.fromkeys(["o_orderkey", "o_orderpriority", *columns])))
    known = F.col("o_orderpriority").isin(*[k for k in LAYOUTS if k != OTHER])
    layout = F.when(known, F.col("o_orderpriority")).otherwise(F.lit(OTHER))
    return o.withColumns({"layout": layout, "book": F.floor(F.col("o_orderkey") / BOOK_ROWS)})


def _path(file) -> Column:
    return F.concat(F.lit("grid/"), F.col("book").cast("string"), F.lit("/"), file)


def data_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One data row per order, in the layout of its workbook."""
    o = _orders(spark, sf_dir, ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    return o.select(
        _path(_by_layout(lambda lay: O.q(lay["path"]))).alias("source_path"),
        _by_layout(lambda lay: O.q(lay["sheet"])).alias("source_sheet"),
        _by_layout(lambda lay: lay["sheet_idx"]).cast("int").alias("sheet_idx"),
        (_by_layout(lambda lay: lay["header_row"] + 1) + F.pmod("o_orderkey", F.lit(BOOK_ROWS))).cast("int").alias("row_idx"),
        _by_layout(_data_cells).alias("cells"),
        F.lit(False).alias("date1904"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(layout, book) of every workbook that orders are dealt into."""
    return _orders(spark, sf_dir, []).select("layout", "book").distinct()


def _labels():
    """(layout, sheet, sheet_idx, row, labels) of the title, note and header rows."""
    for name, lay in LAYOUTS.items():
        yield from ((name, lay["sheet"], lay["sheet_idx"], r, labels) for r, labels in lay["titles"].items())
        yield name, lay["sheet"], lay["sheet_idx"], lay["header_row"], [c[0] for c in lay["columns"]]
        for sheet, idx, extra in lay["extra_sheets"]:
            yield from ((name, sheet, idx, r, labels) for r, labels in extra.items())


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, note and header rows of every workbook."""
    rows = [(layout, LAYOUTS[layout]["path"], sheet, idx, r, {i: ("text", s, None, None) for i, s in enumerate(labels, 1)})
            for layout, sheet, idx, r, labels in _labels()]
    cells = ROWS_SCHEMA["cells"].dataType.simpleString()
    config = spark.createDataFrame(rows, f"layout string, file string, source_sheet string, sheet_idx int, row_idx int, cells {cells}")
    all_rows = books(spark, sf_dir).join(F.broadcast(config), "layout")  # some twenty rows of configuration
    return all_rows.select(_path(F.col("file")).alias("source_path"), "source_sheet", "sheet_idx", "row_idx", "cells",
                           F.lit(False).alias("date1904"))


def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_rows(spark, sf_dir).unionByName(layout_rows(spark, sf_dir))


def grid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_path, dataset, file_rank) of the synthetic workbooks; ranks follow book, then layout."""
    place = {lay["path"]: i for i, lay in enumerate(LAYOUTS.values())}
    rank = F.col("book") * len(LAYOUTS) + _by_layout(lambda lay: place[lay["path"]])
    return books(spark, sf_dir).select(
        _path(_by_layout(lambda lay: O.q(lay["path"]))).alias("source_path"),
        _by_layout(lambda lay: O.q(lay["dataset"])).alias("dataset"), rank.cast("int").alias("file_rank"))


# ---------------------------------------------------------------------------
# The same grid as DuckDB SQL, and header inference over its cells.
# ---------------------------------------------------------------------------
_SERIAL = "date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE))"
_COMMA = "'U$S ' || translate(format('{:,.2f}', o_totalprice), ',.', '.,')"
# kind -> (text form, date, amount) of a cell
_KIND_SQL = {
    "rut_text": ("lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '-' || CAST(o_custkey % 10 AS VARCHAR)", None, None),
    "code_num": ("CAST(o_orderkey AS VARCHAR)", None, "o_orderkey"),
    "code_text": ("' ' || CAST(o_orderkey AS VARCHAR) || ' '", None, None),
    "company": ("'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')", None, None),
    "priority": ("o_orderpriority", None, None),
    "date_cell": ("strftime(o_orderdate, '%Y-%m-%d')", "CAST(o_orderdate AS DATE)", None),
    "date_serial": (f"CAST({_SERIAL} AS VARCHAR)", "CAST(o_orderdate AS DATE)", _SERIAL),
    "date_text": ("strftime(o_orderdate, '%-d/%-m/%Y')", "CAST(o_orderdate AS DATE)", None),
    "status": ("o_orderstatus", None, None),
    "tramo": ("CASE o_orderstatus WHEN 'O' THEN 'Inicial' WHEN 'F' THEN '1a. Ampliación' END", None, None),
    "amount_num": (O.num_to_text("o_totalprice"), None, "o_totalprice"),
    "amount_comma": (_COMMA, None, O.parse_number(_COMMA, "comma")),
    "decoy_text": ("'obs ' || CAST(o_orderkey AS VARCHAR)", None, None),
    "decoy_date": ("strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d')", "CAST(o_orderdate AS DATE) + 30", None),
}


def _values(rows) -> str:
    return ",\n  ".join("(" + ", ".join(O.q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


def inference_cte() -> str:
    """CTE bodies: ``data_cells`` (typed cells of all data rows), ``sheets`` (header row and score), ``names``, ``resolved`` and
    ``chosen``, worked out from the cells alone."""
    known = ", ".join(O.q(k) for k in LAYOUTS if k != OTHER)
    data = []
    for name, lay in LAYOUTS.items():
        for i, (_, _, kind) in enumerate(lay["columns"], 1):
            text, date, amount = _KIND_SQL[kind]
            data.append(f"""SELECT path, {O.q(lay['sheet'])} AS sheet, {lay['sheet_idx']} AS sheet_idx, {lay['header_row'] + 1} + o_orderkey % {BOOK_ROWS} AS row_idx,
         {i} AS col_idx, {text} AS txt, CAST({date or 'NULL'} AS DATE) AS dt, CAST({amount or 'NULL'} AS DOUBLE) AS num
  FROM o WHERE layout = {O.q(name)}""")
    files = _values((k, v["path"], v["dataset"]) for k, v in LAYOUTS.items())
    labels = _values((layout, sheet, idx, r, i, s) for layout, sheet, idx, r, ls in _labels() for i, s in enumerate(ls, 1))
    aliases = _values((f, a, i) for f, words in COLUMN_ALIASES.items() for i, a in enumerate(words, 1))
    excluded = _values(DATASET_EXCLUDED_FIELD.items())
    return f"""
files(layout, file, dataset) AS (VALUES {files}),
labels(layout, sheet, sheet_idx, row_idx, col_idx, txt) AS (VALUES {labels}),
aliases(field, alias, priority) AS (VALUES {aliases}),
excluded(dataset, excluded) AS (VALUES {excluded}),
dealt AS (SELECT *, CASE WHEN o_orderpriority IN ({known}) THEN o_orderpriority ELSE '{OTHER}' END AS layout FROM orders),
o AS (SELECT dealt.*, files.dataset, 'grid/' || CAST(o_orderkey // {BOOK_ROWS} AS VARCHAR) || '/' || file AS path FROM dealt JOIN files USING (layout)),
books AS (SELECT DISTINCT layout, path, dataset FROM o),
data_cells AS ({" UNION ALL ".join(data)}),
cells AS (
  SELECT path, sheet, sheet_idx, CAST(row_idx AS BIGINT) AS row_idx, col_idx, txt FROM labels JOIN books USING (layout)
  UNION ALL SELECT path, sheet, sheet_idx, row_idx, col_idx, txt FROM data_cells),
bounds AS (SELECT path, sheet, min(sheet_idx) AS sheet_idx, min(row_idx) AS first_row FROM cells GROUP BY path, sheet),
near AS (SELECT path, sheet, row_idx, col_idx, txt, {O.norm_name('txt')} AS name FROM cells JOIN bounds USING (path, sheet)
         WHERE row_idx < first_row + {PREVIEW_ROWS} AND {O.as_text('txt')} <> ''),
scores AS (SELECT path, sheet, row_idx, count(DISTINCT field) AS score FROM near JOIN aliases ON contains(name, alias) GROUP BY ALL),
best AS (SELECT path, sheet, row_idx AS best_row, score FROM scores
         QUALIFY row_number() OVER (PARTITION BY path, sheet ORDER BY score DESC, row_idx) = 1),
sheets AS (SELECT path, sheet, b.sheet_idx, first_row, CASE WHEN score >= {MIN_HEADER_SCORE} THEN best_row ELSE first_row END AS header_row,
                  CAST(coalesce(score, 0) AS INTEGER) AS header_score
           FROM bounds b LEFT JOIN best USING (path, sheet)),
header AS (SELECT n.*, count(*) OVER (PARTITION BY path, sheet, txt) AS uses FROM near n JOIN sheets s USING (path, sheet) WHERE n.row_idx = s.header_row),
repaired AS (SELECT path, sheet, col_idx, CASE WHEN uses > 1 THEN txt || '...' || col_idx ELSE txt END AS txt FROM header),
names AS (SELECT path, sheet, col_idx, {O.norm_name('txt')} AS name FROM repaired),
resolved AS (SELECT path, sheet, field, col_idx, name FROM names JOIN aliases ON contains(name, alias)
             QUALIFY row_number() OVER (PARTITION BY path, sheet, field
                                        ORDER BY name <> alias, CASE WHEN name = alias THEN priority ELSE 0 END, col_idx) = 1),
scored AS (SELECT b.path, b.dataset, s.sheet, s.sheet_idx, s.header_row, s.header_score,
                  CAST(count(r.field) FILTER (WHERE r.field <> e.excluded) AS INTEGER) AS sheet_score
           FROM books b JOIN excluded e USING (dataset) JOIN sheets s USING (path) LEFT JOIN resolved r ON r.path = s.path AND r.sheet = s.sheet
           GROUP BY ALL),
chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY path, dataset ORDER BY sheet_score DESC, sheet_idx) = 1)"""
