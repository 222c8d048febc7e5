"""Canonical register rows from raw field values.

``standardize`` is the single place where raw values become the canonical
17-column register: text fields are squished and blank-folded, identifiers
are normalised, the ministry is classified, the tranche is cleaned, the
composite key is built and rows without any key field are dropped.  Raw
values may come from workbook cells (see ``plans.pipeline``) or from any
table (see ``plans.standins``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfuse.functions import text as tx
from regfuse.functions.constants import MINISTRY_RULES
from regfuse.operators.linkage import REGISTER_COLUMNS


def _lit_null(t: str) -> Column:
    return F.lit(None).cast(t)


def standardize(
    df: DataFrame,
    *,
    rut: Column | None = None,
    codigo: Column | None = None,
    empresa: Column | None = None,
    ministerio_evaluador: Column | None = None,
    fecha_presentado: Column | None = None,
    fecha_recomendado: Column | None = None,
    regimen: Column | None = None,
    tramo: Column | None = None,
    monto_ui: Column | None = None,
    source_file: Column | None = None,
    source_path: Column | None = None,
    source_sheet: Column | None = None,
    source_header_row: Column | None = None,
    source_row: Column | None = None,
    order: Column | None = None,
    order_col: str = "_order",
    extra: dict[str, Column] | None = None,
    ministry_rules=MINISTRY_RULES,
    drop_blank: bool = True,
) -> DataFrame:
    """Raw text / typed values -> canonical register columns (+ ``order_col``).

    Missing fields are typed NULL columns.  ``rut`` / ``codigo`` /
    ``empresa`` / ``ministerio_evaluador`` / ``regimen`` / ``tramo`` are text,
    the two dates are ``date``, ``monto_ui`` is ``double``."""

    def text(c):
        return _lit_null("string") if c is None else c.cast("string")

    def typed(c, t):
        return (c if c is not None else _lit_null(t)).cast(t)

    # stage 1: raw values, provenance, order
    raw = {
        "source_file": typed(source_file, "string"),
        "source_path": typed(source_path, "string"),
        "source_sheet": typed(source_sheet, "string"),
        "source_header_row": typed(source_header_row, "int"),
        "source_row": typed(source_row, "bigint"),
        "_r_rut": text(rut),
        "_r_codigo": text(codigo),
        "_r_empresa": text(empresa),
        "_r_min": text(ministerio_evaluador),
        "fecha_presentado": typed(fecha_presentado, "date"),
        "fecha_recomendado": typed(fecha_recomendado, "date"),
        "_r_regimen": text(regimen),
        "_r_tramo": text(tramo),
        "monto_ui": typed(monto_ui, "double"),
    }
    if order is not None:
        raw[order_col] = order
    for k, v in (extra or {}).items():
        raw[k] = v
    out = df.select(*[v.alias(k) for k, v in raw.items()])
    carried = [k for k in raw if not k.startswith("_r_")]

    if drop_blank:
        # A row survives when any key field is present.  Tested on the raw
        # values with cheap predicates (cheapest first, OR short-circuits), so
        # the filter can be pushed below the normalisers without running
        # them twice.
        rut_raw, cod_raw = F.col("_r_rut"), F.col("_r_codigo")
        has_digit = F.length(F.translate(rut_raw, "0123456789", "")) < F.length(rut_raw)
        cod_trim = F.trim(tx._fold_whitespace(cod_raw))
        present = (
            F.col("monto_ui").isNotNull()
            | F.col("fecha_presentado").isNotNull()
            | F.col("fecha_recomendado").isNotNull()
            | F.coalesce(has_digit, F.lit(False))
            | F.coalesce((F.length(cod_trim) > 0) & (cod_trim != ".0"), F.lit(False))
            | tx.has_text("_r_empresa")
            | tx.has_text("_r_min")
        )
        out = out.where(present)

    # stage 2: squished text
    out = out.select(
        *carried,
        tx.normalize_rut("_r_rut").alias("rut"),
        tx.normalize_codigo("_r_codigo").alias("codigo"),
        tx.blank_to_null(tx.as_text("_r_empresa")).alias("empresa"),
        tx.as_text("_r_min").alias("_t_min"),
        tx.blank_to_null(tx.as_text("_r_regimen")).alias("regimen"),
        tx.blank_to_null(tx.as_text("_r_tramo")).alias("tramo"),
    )
    # stage 3: normalised names (computed once, tested by several rules)
    out = out.withColumns(
        {
            "_n_min": tx.normalize_name("_t_min"),
            "tramo_clean": tx.tramo_clean("tramo"),
            "project_key": tx.composite_key("rut", "codigo"),
        }
    )
    # stage 4: classification and flags
    out = out.withColumns(
        {
            "ministerio_evaluador": tx.blank_to_null(tx.classify_ministerio("_n_min", "_t_min", ministry_rules)),
            "es_ampliacion": tx.es_ampliacion("tramo_clean"),
        }
    )
    keep = REGISTER_COLUMNS + ([order_col] if order is not None else []) + list(extra or {})
    return out.select(*keep)

