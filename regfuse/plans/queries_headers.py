"""Header inference, best sheet, alias resolution and canonical projection on
workbook rows synthesised from ``orders`` (see ``grid.py``); the SQL infers from the same cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from regfuse.functions.constants import CANONICAL_FIELDS
from regfuse.operators import deck
from regfuse.operators import headers as H
from regfuse.plans import grid
from regfuse.plans import oracle as O
from regfuse.plans.pipeline import infer, register_rows
from regfuse.plans.registry import register

_CTE = f"WITH {grid.inference_cte()}"


def _inference(spark, sf_dir):
    return infer(grid.grid_rows(spark, sf_dir), grid.grid_files(spark, sf_dir))


# ---- H3 H4 W2 O4 O5 S6 ------------------------------------------------------
@register("header_row_detect", f"""{_CTE}
SELECT path AS source_path, sheet AS source_sheet, CAST(header_row AS INTEGER) AS header_row, header_score FROM sheets""")
def q_header_row_detect(spark, sf_dir):
    sheets = H.sheets(grid.grid_rows(spark, sf_dir))
    return H.header_rows(sheets).select("source_path", "source_sheet", "header_row", "header_score")


# ---- H5 ---------------------------------------------------------------------
@register("header_names", f"""{_CTE}
SELECT path AS source_path, sheet AS source_sheet, col_idx, name FROM names WHERE name <> ''""")
def q_header_names(spark, sf_dir):
    return H.header_names(H.sheets(grid.grid_rows(spark, sf_dir))).drop("raw")


# ---- H2 H9 ------------------------------------------------------------------
@register("alias_resolve", f"""{_CTE}
SELECT path AS source_path, sheet AS source_sheet, field, col_idx, name AS column_name FROM resolved""")
def q_alias_resolve(spark, sf_dir):
    return H.resolved_columns(H.sheets(grid.grid_rows(spark, sf_dir))).drop("exact")


# ---- H6 H7 H8 ---------------------------------------------------------------
@register("best_sheet", f"""{_CTE}
SELECT path AS source_path, dataset, sheet AS source_sheet, CAST(header_row AS INTEGER) AS header_row, sheet_score FROM chosen""")
def q_best_sheet(spark, sf_dir):
    return _inference(spark, sf_dir).chosen.select("source_path", "dataset", "source_sheet", "header_row", "sheet_score")


# ---- D8 ---------------------------------------------------------------------
@register("schema_versions", f"""{_CTE},
layouts AS (SELECT c.path, c.dataset, string_agg(r.field || '=' || r.name, '|' ORDER BY r.field || '=' || r.name) AS layout
            FROM chosen c JOIN resolved r USING (path, sheet) GROUP BY c.path, c.dataset)
SELECT dataset, layout, count(*) AS libros FROM layouts GROUP BY dataset, layout""")
def q_schema_versions(spark, sf_dir):
    v = deck.schema_versions(_inference(spark, sf_dir).chosen)
    return v.select("dataset", F.concat_ws("|", "layout").alias("layout"), "libros")


# ---- S7 H9 H10 F1-F11 P1 (canonical rows from the grid) ----------------------
_FORM = {"fecha_presentado": "dt", "fecha_recomendado": "dt", "monto_ui": "num"}
_NORMAL = {
    "rut": O.norm_rut("rut"), "codigo": O.norm_codigo("codigo"), "ministerio_evaluador": f"nullif({O.norm_ministerio('ministerio_evaluador')}, '')",
    **{f: f"nullif({O.as_text(f)}, '')" for f in ("empresa", "regimen", "tramo")},
}


def _canonical_sql() -> str:
    raw = ", ".join(f"max(CASE WHEN field = '{f}' THEN {_FORM.get(f, 'txt')} END) AS {f}" for f in CANONICAL_FIELDS)
    normal = ", ".join(f"{e} AS {f}" for f, e in _NORMAL.items())
    tc = O.tramo_clean("tramo")
    return f"""{_CTE},
mapped AS (SELECT c.dataset, c.path, c.sheet, c.header_row, r.field, r.col_idx FROM chosen c JOIN resolved r USING (path, sheet)),
raw AS (SELECT m.dataset, m.path, m.sheet, m.header_row, d.row_idx, {raw}
        FROM data_cells d JOIN mapped m ON d.path = m.path AND d.sheet = m.sheet AND d.col_idx = m.col_idx
        WHERE d.row_idx > m.header_row GROUP BY ALL),
c AS (SELECT * REPLACE ({normal}) FROM raw)
SELECT dataset, path AS source_path, sheet AS source_sheet, CAST(header_row AS INTEGER) AS source_header_row, row_idx AS source_row,
       {", ".join(CANONICAL_FIELDS)}, {tc} AS tramo_clean, contains({tc}, 'ampl') AS es_ampliacion, rut || '::' || codigo AS project_key
FROM c"""


@register("canonical_pivot", _canonical_sql())
def q_canonical_pivot(spark, sf_dir):
    rows, files = grid.grid_rows(spark, sf_dir), grid.grid_files(spark, sf_dir)
    cols = ["dataset", "source_path", "source_sheet", "source_header_row", "source_row", *CANONICAL_FIELDS,
            "tramo_clean", "es_ampliacion", "project_key"]
    return register_rows(rows, infer(rows, files).chosen).select(*cols)
