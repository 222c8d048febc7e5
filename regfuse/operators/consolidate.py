"""Consolidation: one authoritative table from the two registers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfuse.functions.text import composite_key
from regfuse.operators.linkage import link_key, link_presented, recommended_only
from regfuse.operators.rowid import dense_row_ids
from regfuse.session import freed, materialize, remove, remove_path, stored_bytes

AUTHORITATIVE_COLUMNS = [
    "project_row_id", "source", "match_method", "rut", "codigo", "project_key",
    "empresa", "ministerio_evaluador", "fecha_presentado", "fecha_recomendado", "regimen",
    "tramo", "es_ampliacion", "monto_ui_presentado", "monto_ui_recomendado",
    "monto_ui_beneficios", "has_benefits", "recommended_rows_for_key",
    "source_file", "source_sheet", "source_row",
]

# register columns that neither the link nor the published table reads
_UNREAD = {"source_path", "source_header_row"}

# a register is written in so many slices by key, and those that are linked at once hold so many bytes (a slice at least)
SLICES = 8
SLICE_BYTES = 64 << 20


def linked_union(presented: DataFrame, recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """Linked presented rows followed by recommended-only rows (union by name).

    ``_branch`` (0 presented, 1 recommended-only) and the two registers' order
    columns (``_order_p``, ``_order_r``) keep the bind order for row ids."""
    p = link_presented(presented, recommended, order_col).withColumns(
        {"_branch": F.lit(0), "_order_p": F.col(order_col)}
    ).drop(order_col)
    r = recommended_only(presented, recommended, order_col).withColumns(
        {"_branch": F.lit(1), "_order_r": F.col(order_col)}
    ).drop(order_col)
    return p.unionByName(r, allowMissingColumns=True)


def authoritative_columns(u: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The published projection (without the row id) and the ``extra`` columns."""
    fr = F.col("fecha_recomendado")
    return u.select(
        "_branch", "_order_p", "_order_r",
        "source", "match_method", "rut", "codigo", "project_key", "empresa",
        F.coalesce("ministerio_evaluador", "ministerio_recomendado").alias("ministerio_evaluador"),
        "fecha_presentado",
        "fecha_recomendado",
        F.coalesce("regimen_recomendado", "regimen").alias("regimen"),
        "tramo",
        "es_ampliacion",
        F.col("monto_ui").alias("monto_ui_presentado"),
        "monto_ui_recomendado",
        F.when(fr.isNotNull(), F.coalesce("monto_ui_recomendado", "monto_ui")).alias("monto_ui_beneficios"),
        fr.isNotNull().alias("has_benefits"),
        F.coalesce("recommended_rows_exact", "recommended_rows_project").alias("recommended_rows_for_key"),
        "source_file", "source_sheet", "source_row", *extra,
    )


def numbered_by_slices(presented: DataFrame, recommended: DataFrame, order_col: str = "_order", extra: tuple[str, ...] = ()) -> DataFrame:
    """``authoritative_columns`` of ``linked_union`` with dense ids, written; disk holds the exchanges of one step at a time,
    and of the link those of one slice of the keys.

    The registers are written once, in slices by key (a key's rows of both are in the same slice; a row without one links
    with nothing and may be in any), the presented one with its ids: they come first and none is lost.  Then slices are
    linked one after the other, several at once while they are small.  Recommended-only rows are numbered behind them.  What
    was written for a step goes when nothing reads it any more."""
    spark, id_col, columns = presented.sparkSession, "project_row_id", [*AUTHORITATIVE_COLUMNS, *extra]
    place_r = ("source_sheet", "source_row", "monto_ui")

    def in_slices(df: DataFrame, *place: str) -> DataFrame:
        return materialize(df.withColumn("_slice", F.pmod(F.xxhash64(link_key(*place)), F.lit(SLICES)).cast("int")), ("_slice",))

    unread = [c for c in _UNREAD if c not in extra]
    with freed(spark):
        rec = in_slices(recommended.drop(*unread), *place_r)
        ids = dense_row_ids(presented.drop(*unread), [order_col], id_col)
        pres = in_slices(ids, order_col)
        remove(ids)
        groups, held = [], 0
        for i in range(SLICES):
            paths = [f"{df.materialized_path}/_slice={i}" for df in (pres, rec)]
            size = sum(stored_bytes(spark, path) for path in paths)
            if not groups or held + size > SLICE_BYTES:
                groups, held = [*groups, []], 0
            groups[-1].append((i, paths))
            held += size
        parts = []
        for group in groups:
            p, r = (df.where(F.col("_slice").isin([i for i, _ in group])).drop("_slice") for df in (pres, rec))
            parts.append(materialize(authoritative_columns(linked_union(p, r, order_col), (*extra, id_col)), ("_branch",)))
            for path in (path for _, paths in group for path in paths):
                remove_path(spark, path)
        remove(pres)
        remove(rec)
    linked = reduce(DataFrame.unionByName, parts)
    first = linked.where(F.col("_branch") == 0)
    only = dense_row_ids(linked.where(F.col("_branch") == 1).drop("_branch", "_order_p", id_col), ["_order_r"], id_col)
    for part in parts:
        remove_path(spark, f"{part.materialized_path}/_branch=1")
    only = only.withColumn(id_col, F.col(id_col) + F.lit(first.count()))
    return first.select(*columns).unionByName(only.select(*columns))


def authoritative(presented: DataFrame, recommended: DataFrame, order_col: str = "_order",
                  with_ids: bool = True, sort: bool = True, extra: tuple[str, ...] = (),
                  columns: tuple[str, ...] | None = None) -> DataFrame:
    """The 21-column authoritative table, and the registers' columns ``extra``.

    ``with_ids``: dense ``project_row_id`` in bind order (presented rows in
    file order, then recommended-only rows in file order) - assigned before
    the final sort, as in the source pipeline.  Reports that do not publish
    the id can pass ``with_ids=False`` and skip that pass.  With ids the table is
    written once, so what is returned reads it at little cost: whole, it is made
    slice by slice (``numbered_by_slices``); ``columns`` names
    those that are wanted beside the id, and no other is linked, dealt out or
    written (not with ``sort``, which needs its own)."""
    if with_ids and columns is None:
        a = numbered_by_slices(presented, recommended, order_col, extra)
        return sort_authoritative(a) if sort else a
    published = [c for c in AUTHORITATIVE_COLUMNS if columns is None or c in (*columns, "project_row_id")]
    a = authoritative_columns(linked_union(presented, recommended, order_col), extra)
    a = a.select("_branch", "_order_p", "_order_r", *[c for c in published if c != "project_row_id"], *extra)
    if with_ids:
        a = dense_row_ids(a, ["_branch", "_order_p", "_order_r"], "project_row_id")
    else:
        a = a.withColumn("project_row_id", F.lit(None).cast("bigint"))
    a = a.select(*published, *extra)
    return sort_authoritative(a) if sort else a


def _derived() -> dict[str, Column]:
    """Columns of the table that follow from others of it."""
    dated = F.col("fecha_recomendado").isNotNull()
    return {
        "source": F.when(F.col("match_method") == "recomendado_only", F.lit("recomendado_only")).otherwise(F.lit("presentado")),
        "project_key": composite_key("rut", "codigo"),
        "monto_ui_beneficios": F.when(dated, F.coalesce("monto_ui_recomendado", "monto_ui_presentado")),
        "has_benefits": dated,
    }


def sort_authoritative(a: DataFrame) -> DataFrame:
    """Published order: rut, codigo, presentation date, tranche (NULLs last),
    ties in row-id order (a distributed range sort).

    Of a column that follows from others only the values that differ from what
    follows are exchanged."""
    odd = {c: F.when(~F.col(c).eqNullSafe(v), F.struct(F.col(c).alias("v"))) for c, v in _derived().items()}
    ordered = a.select(*[odd[c].alias(c) if c in odd else F.col(c) for c in a.columns]).orderBy(
        F.col("rut").asc_nulls_last(),
        F.col("codigo").asc_nulls_last(),
        F.col("fecha_presentado").asc_nulls_last(),
        F.col("tramo").asc_nulls_last(),
        F.col("project_row_id").asc_nulls_last(),
    )
    whole = {c: F.when(F.col(c).isNotNull(), F.col(c).getField("v")).otherwise(v) for c, v in _derived().items()}
    return ordered.select(*[whole[c].alias(c) if c in whole else F.col(c) for c in a.columns])
