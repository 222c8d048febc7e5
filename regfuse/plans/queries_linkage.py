"""Linkage family: rollups, tiered link, recommended-only, consolidation, reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.operators import consolidate, linkage, placement, reports
from regfuse.operators.rowid import dense_row_ids
from regfuse.plans import oracle as O
from regfuse.plans import standins
from regfuse.plans.registry import register
from regfuse.session import checkpoint_dir, freed, materialize, remove, remove_path, scratch
from regfuse.sources import sinks

# --------------------------------------------------------------------------

def _auth(spark, sf_dir, with_ids=False, sort=False):
    p, r = standins.registers(spark, sf_dir)
    return consolidate.authoritative(p, r, with_ids=with_ids, sort=sort)


@register("linkage_audit", f"""WITH {O.linkage_cte()}
SELECT match_method, source, count(*) AS rows FROM auth GROUP BY match_method, source
ORDER BY match_method, source""")
def q_linkage_audit(spark, sf_dir):
    return reports.linkage_audit(_auth(spark, sf_dir))


@register("authoritative", f"""WITH {O.linkage_cte()}
SELECT * FROM auth ORDER BY rut NULLS LAST, codigo NULLS LAST, fecha_presentado NULLS LAST,
         tramo NULLS LAST, project_row_id""")
def q_authoritative(spark, sf_dir):
    return _auth(spark, sf_dir, with_ids=True, sort=True)


@register("summary_by_group", f"""WITH {O.linkage_cte()}
SELECT coalesce(ministerio_evaluador, 'SIN_DATO') AS ministerio_evaluador,
       count(*) AS filas,
       count(DISTINCT project_key) AS proyectos,
       count(*) FILTER (WHERE es_ampliacion) AS ampliaciones,
       count(DISTINCT project_key) FILTER (WHERE has_benefits) AS proyectos_con_beneficios,
       count(*) FILTER (WHERE has_benefits) AS filas_con_beneficios,
       round(coalesce(sum(monto_ui_beneficios), 0.0), 2) AS monto_ui_beneficios,
       round(coalesce(sum(monto_ui_presentado), 0.0), 2) AS monto_ui_presentado
FROM auth GROUP BY 1 ORDER BY monto_ui_beneficios DESC, ministerio_evaluador""")
def q_summary_by_group(spark, sf_dir):
    return reports.summary_by_group(_auth(spark, sf_dir))


@register("unlinked_recommended", f"""WITH {O.registers_cte()}
SELECT r.project_key, r.tramo_clean, r.fecha_recomendado, r.regimen, r.monto_ui
FROM rec r
WHERE r.project_key IS NOT NULL
  AND EXISTS (SELECT 1 FROM pres p WHERE p.project_key = r.project_key)
  AND NOT EXISTS (SELECT 1 FROM pres p WHERE p.project_key = r.project_key
                  AND p.tramo_clean = r.tramo_clean AND p.tramo_clean <> '')
  AND (SELECT count(*) FROM rec r2 WHERE r2.project_key = r.project_key) > 1""")
def q_unlinked_recommended(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    return linkage.unlinked_recommended(p, r).select(
        "project_key", "tramo_clean", "fecha_recomendado", "regimen", "monto_ui"
    )


@register("exact_rollup", f"""WITH {O.linkage_cte()}
SELECT * FROM exact""")
def q_exact_rollup(spark, sf_dir):
    return linkage.exact_rollup(standins.recommended_register(spark, sf_dir))


@register("project_rollup", f"""WITH {O.linkage_cte()}
SELECT * FROM proj""")
def q_project_rollup(spark, sf_dir):
    return linkage.project_rollup(standins.recommended_register(spark, sf_dir))


@register("recommended_only", f"""WITH {O.linkage_cte()}
SELECT project_key, rut, codigo, tramo_clean, fecha_recomendado, regimen, monto_ui,
       recommended_tramos, match_method FROM ronly""")
def q_recommended_only(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    return linkage.recommended_only(p, r).select(
        "project_key", "rut", "codigo", "tramo_clean", "fecha_recomendado", "regimen",
        "monto_ui", "recommended_tramos", "match_method",
    )


@register("fallback_unique", f"""WITH {O.linkage_cte()}
SELECT ord AS presentado_order, project_key, tramo_clean, fecha_recomendado, regimen_recomendado,
       monto_ui_recomendado, ministerio_recomendado, recommended_rows_project
FROM linked WHERE match_method = 'rut_codigo_unique'""")
def q_fallback_unique(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    return (
        linkage.link_presented(p, r)
        .where(F.col("match_method") == "rut_codigo_unique")
        .select(
            F.col("_order").alias("presentado_order"), "project_key", "tramo_clean",
            "fecha_recomendado", "regimen_recomendado", "monto_ui_recomendado",
            "ministerio_recomendado", "recommended_rows_project",
        )
    )


# ---- O1 O2 O3: the published order, as a column --------------------------------
@register("published_order", f"""WITH {O.linkage_cte()},
by_group AS (SELECT coalesce(ministerio_evaluador, 'SIN_DATO') AS g, round(coalesce(sum(monto_ui_beneficios), 0.0), 2) AS m FROM auth GROUP BY 1),
audit AS (SELECT match_method, source FROM auth GROUP BY ALL)
SELECT 'projects_authoritative' AS published, CAST(project_row_id AS VARCHAR) AS row_name,
       row_number() OVER (ORDER BY rut NULLS LAST, codigo NULLS LAST, fecha_presentado NULLS LAST, tramo NULLS LAST, project_row_id) AS place
FROM auth
UNION ALL SELECT 'summary_by_ministerio', g, row_number() OVER (ORDER BY m DESC, g) FROM by_group
UNION ALL SELECT 'linkage_audit', match_method || '/' || source, row_number() OVER (ORDER BY match_method, source) FROM audit""")
def q_published_order(spark, sf_dir):
    """Where each row stands in the published tables: places are taken from the written files, not computed again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    row_names = {
        "projects_authoritative": F.col("project_row_id").cast("string"),
        "summary_by_ministerio": F.col("ministerio_evaluador"),
        "linkage_audit": F.concat("match_method", F.lit("/"), "source"),
    }
    with scratch(spark):  # the table goes when the published ones are written
        auth = _auth(spark, sf_dir, with_ids=True)  # written as it is numbered
        tables = [consolidate.sort_authoritative(auth), reports.summary_by_group(auth), reports.linkage_audit(auth)]
        for name, df in zip(row_names, tables, strict=True):
            with freed(spark):
                sinks.write(df, f"{folder}/{name}", "parquet")
    placed = {}
    for name, row_name in row_names.items():
        read = spark.read.parquet(f"{folder}/{name}").select(row_name.alias("row_name"), sinks.file_place())
        placed[name] = dense_row_ids(read, ["_file", "_row"], "place")
    parts = [df.select(F.lit(name).alias("published"), "row_name", "place") for name, df in placed.items()]
    with freed(spark):
        out = materialize(reduce(DataFrame.unionByName, parts))
    for df in placed.values():
        remove(df)
    remove_path(spark, folder)
    return out


# ---- J1-J5 on a placed register ----------------------------------------------
@register("relinked", f"""WITH {O.linkage_cte()}
SELECT project_key, tramo_clean, fecha_recomendado, regimen_recomendado, monto_ui_recomendado, match_method FROM linked
UNION ALL SELECT project_key, tramo_clean, fecha_recomendado, regimen_recomendado, monto_ui_recomendado, match_method FROM ronly""")
def q_relinked(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    name = f"placed_{uuid.uuid4().hex}"
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    placed = placement.place(p, name, folder)
    columns = ["project_key", "tramo_clean", "fecha_recomendado", "regimen_recomendado", "monto_ui_recomendado", "match_method"]
    linked = placement.relink(spark, placed, r).select(*columns)
    out = materialize(linked.unionByName(placement.relinked_only(spark, placed, r).select(*columns)))
    placement.remove_placed(spark, placed)
    remove_path(spark, folder)
    return out
