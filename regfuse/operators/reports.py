"""Published indicators over the authoritative table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary_by_group(auth: DataFrame, group_col: str = "ministerio_evaluador",
                     missing_label: str = "SIN_DATO", money_scale: int | None = 2) -> DataFrame:
    """Rows, projects, extensions, benefits and amounts per group.

    NULL group -> ``missing_label``; empty sums are 0.  ``money_scale`` rounds
    the two amount sums (double sums depend on addition order, so equal data
    can differ in the last bits between runs and engines)."""
    hb = F.col("has_benefits")

    def money(c):
        s = F.coalesce(F.sum(c), F.lit(0.0))
        return F.round(s, money_scale) if money_scale is not None else s

    return (
        auth.withColumn(group_col, F.coalesce(F.col(group_col), F.lit(missing_label)))
        .groupBy(group_col)
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.count_distinct("project_key").alias("proyectos"),
            F.count_if(F.col("es_ampliacion")).alias("ampliaciones"),
            F.count_distinct(F.when(hb, F.col("project_key"))).alias("proyectos_con_beneficios"),
            F.count_if(hb).alias("filas_con_beneficios"),
            money("monto_ui_beneficios").alias("monto_ui_beneficios"),
            money("monto_ui_presentado").alias("monto_ui_presentado"),
        )
        .orderBy(F.col("monto_ui_beneficios").desc_nulls_last(), F.col(group_col).asc_nulls_last())
    )


def linkage_audit(auth: DataFrame) -> DataFrame:
    """How every output row was matched: count by (match_method, source)."""
    return (
        auth.groupBy("match_method", "source")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("match_method", "source")
    )
