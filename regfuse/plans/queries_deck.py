"""Deck indicators, ledgers, lookups, row ids, unions and the file inventory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from regfuse.operators import consolidate, deck, reports
from regfuse.operators.rowid import dense_row_ids
from regfuse.plans import oracle as O
from regfuse.plans import standins
from regfuse.plans.registry import register
from regfuse.plans.standins import table
from regfuse.session import checkpoint_dir, materialize
from regfuse.sources import sinks
from regfuse.sources import workbook as W

METHODS = ["rut_codigo_tramo", "rut_codigo_unique", "rut_codigo_ambiguous", "presentado_only", "recomendado_only"]


def _auth(spark, sf_dir, with_ids=False):
    p, r = standins.registers(spark, sf_dir)
    return consolidate.authoritative(p, r, with_ids=with_ids, sort=False)


def _auth_g() -> str:
    return "ag AS (SELECT * REPLACE (coalesce(ministerio_evaluador, 'SIN_DATO') AS ministerio_evaluador) FROM auth)"


# ---- D1 -------------------------------------------------------------------
@register("promoted_projects", f"""WITH {O.linkage_cte()}, {_auth_g()}
SELECT ministerio_evaluador,
       count(DISTINCT CASE WHEN has_benefits THEN project_key END) AS proyectos_promovidos,
       count(*) FILTER (WHERE has_benefits) AS filas_con_beneficios,
       count(DISTINCT project_key) AS proyectos,
       grouping(ministerio_evaluador) = 1 AS is_total
FROM ag GROUP BY ROLLUP (ministerio_evaluador)""")
def q_promoted_projects(spark, sf_dir):
    return deck.promoted_projects(_auth(spark, sf_dir))


# ---- D2 -------------------------------------------------------------------
@register("approval_time", f"""WITH {O.linkage_cte()}, {_auth_g()},
d AS (SELECT ministerio_evaluador, date_diff('day', fecha_presentado, fecha_recomendado) AS dias
      FROM ag WHERE fecha_presentado IS NOT NULL AND fecha_recomendado IS NOT NULL),
ranked AS (SELECT ministerio_evaluador, dias,
                  row_number() OVER (PARTITION BY ministerio_evaluador ORDER BY dias) - 1 AS rn,
                  count(*) OVER (PARTITION BY ministerio_evaluador) AS n
           FROM d WHERE dias >= 0),
q AS (SELECT ministerio_evaluador,
             min(dias) FILTER (WHERE rn = floor((n - 1) * 0.5)) AS mediana_dias,
             min(dias) FILTER (WHERE rn = floor((n - 1) * 0.9)) AS p90_dias
      FROM ranked GROUP BY ministerio_evaluador),
st AS (SELECT ministerio_evaluador, count(*) FILTER (WHERE dias < 0) AS negativos,
              count(*) FILTER (WHERE dias >= 0) AS n,
              round(avg(CASE WHEN dias >= 0 THEN dias END), 4) AS media_dias
       FROM d GROUP BY 1)
SELECT ministerio_evaluador, negativos, n, media_dias, mediana_dias, p90_dias
FROM st LEFT JOIN q USING (ministerio_evaluador)""")
def q_approval_time(spark, sf_dir):
    return deck.approval_time(_auth(spark, sf_dir))


# ---- D2 (values that need not repeat) ------------------------------------------
@register("amount_quantiles", f"""WITH {O.linkage_cte()}, {_auth_g()},
ranked AS (SELECT ministerio_evaluador, monto_ui_presentado AS x,
                  row_number() OVER (PARTITION BY ministerio_evaluador ORDER BY monto_ui_presentado) - 1 AS rn,
                  count(*) OVER (PARTITION BY ministerio_evaluador) AS n
           FROM ag WHERE monto_ui_presentado IS NOT NULL)
SELECT ministerio_evaluador, min(x) FILTER (WHERE rn = floor((n - 1) * 0.5)) AS mediana,
       min(x) FILTER (WHERE rn = floor((n - 1) * 0.9)) AS p90, min(x) FILTER (WHERE rn = floor((n - 1) * 0.99)) AS p99
FROM ranked GROUP BY ministerio_evaluador""")
def q_amount_quantiles(spark, sf_dir):
    return deck.amount_quantiles(_auth(spark, sf_dir))


# ---- D3 -------------------------------------------------------------------
@register("approval_time_rollup", f"""WITH {O.linkage_cte()},
d AS (SELECT *, year(fecha_presentado) AS anio, quarter(fecha_presentado) AS trimestre,
             month(fecha_presentado) AS mes, date_diff('day', fecha_presentado, fecha_recomendado) AS dias
      FROM auth)
SELECT anio, trimestre, mes, count(*) AS filas, count(DISTINCT project_key) AS proyectos,
       count(DISTINCT CASE WHEN has_benefits THEN project_key END) AS proyectos_promovidos,
       round(coalesce(sum(monto_ui_beneficios), 0.0), 2) AS monto_ui_beneficios,
       round(avg(CASE WHEN dias >= 0 THEN dias END), 4) AS media_dias,
       grouping(anio, trimestre, mes) AS nivel
FROM d GROUP BY ROLLUP (anio, trimestre, mes)""")
def q_approval_time_rollup(spark, sf_dir):
    return deck.approval_time_rollup(_auth(spark, sf_dir))


# ---- D4 -------------------------------------------------------------------
_method_cols = ",\n       ".join(f"count(*) FILTER (WHERE match_method = '{m}') AS {m}" for m in METHODS)
_method_sel = ", ".join(f"coalesce(m.{m}, 0) AS {m}" for m in METHODS)


@register("form_ledger", f"""WITH {O.linkage_cte()},
reg AS (SELECT source_file, project_key, tramo_clean FROM pres
        UNION ALL SELECT source_file, project_key, tramo_clean FROM rec),
base AS (SELECT source_file, count(*) AS filas, count(project_key) AS filas_con_clave,
                count(DISTINCT project_key) AS claves FROM reg GROUP BY source_file),
dup AS (SELECT source_file, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS filas_clave_duplicada
        FROM (SELECT source_file, project_key, tramo_clean, count(*) AS n FROM reg
              WHERE project_key IS NOT NULL GROUP BY ALL) GROUP BY source_file),
m AS (SELECT source_file,
       {_method_cols}
      FROM auth GROUP BY source_file)
SELECT base.source_file, base.filas, base.filas_con_clave, base.claves,
       coalesce(dup.filas_clave_duplicada, 0) AS filas_clave_duplicada, {_method_sel}
FROM base LEFT JOIN dup USING (source_file) LEFT JOIN m USING (source_file)""")
def q_form_ledger(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    auth = consolidate.authoritative(p, r, with_ids=False, sort=False)
    reg = p.select("source_file", "project_key", "tramo_clean").unionByName(
        r.select("source_file", "project_key", "tramo_clean"))
    return deck.register_ledger(reg, auth)


# ---- D5 -------------------------------------------------------------------
@register("drill_through", f"""WITH {O.linkage_cte()}, {_auth_g()}
SELECT ministerio_evaluador, project_row_id, project_key, match_method, source_file, source_sheet, source_row
FROM ag WHERE has_benefits""")
def q_drill_through(spark, sf_dir):
    p, r = standins.registers(spark, sf_dir)
    columns = ("ministerio_evaluador", "project_key", "match_method", "has_benefits", "source_file", "source_sheet", "source_row")
    return deck.drill_through(consolidate.authoritative(p, r, with_ids=True, sort=False, columns=columns))


# ---- D9 (sampling is the feature) -------------------------------------------
@register("key_sample", f"""WITH {O.linkage_cte()},
k AS (SELECT *, coalesce(project_key, concat_ws('#', source_file, source_sheet, CAST(source_row AS VARCHAR))) AS k FROM auth)
SELECT project_key, match_method, source_file, source_row FROM k
WHERE CAST('0x' || md5(k)[1:8] AS BIGINT) % 10 = 0""")
def q_key_sample(spark, sf_dir):
    return deck.key_sample(_auth(spark, sf_dir), buckets=10).select(
        "project_key", "match_method", "source_file", "source_row")


# ---- D10 ------------------------------------------------------------------
_TERM = "customer#0000001"


@register("company_lookup", f"""WITH {O.linkage_cte()}
SELECT project_key, empresa, match_method, source_file, source_row FROM auth
WHERE coalesce(contains({O.norm_name('empresa')}, {O.q('customer_0000001')}), false)
   OR coalesce(rut = '0000001', false)""")
def q_company_lookup(spark, sf_dir):
    return deck.company_lookup(_auth(spark, sf_dir), _TERM).select(
        "project_key", "empresa", "match_method", "source_file", "source_row")


@register("company_profile", f"""WITH {O.linkage_cte()}
SELECT rut, min(empresa) AS empresa, count(*) AS filas, count(DISTINCT project_key) AS proyectos,
       count(DISTINCT CASE WHEN has_benefits THEN project_key END) AS proyectos_con_beneficios,
       round(coalesce(sum(monto_ui_presentado), 0.0), 2) AS monto_ui_presentado,
       round(coalesce(sum(monto_ui_beneficios), 0.0), 2) AS monto_ui_beneficios,
       min(fecha_presentado) AS primera_presentacion, max(fecha_presentado) AS ultima_presentacion,
       max(fecha_recomendado) AS ultima_recomendacion
FROM auth WHERE rut IS NOT NULL GROUP BY rut""")
def q_company_profile(spark, sf_dir):
    return deck.company_profile(_auth(spark, sf_dir))


# ---- D12 ------------------------------------------------------------------
_DIMS = ["ministerio_evaluador", "match_method", "regimen"]
_dim_name = "CASE " + " ".join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in _DIMS) + " ELSE 'total' END"
_dim_val = "CASE " + " ".join(f"WHEN grouping({d}) = 0 THEN {d}" for d in _DIMS) + " ELSE 'total' END"


@register("metric_registry", f"""WITH {O.linkage_cte()},
a AS (SELECT * REPLACE ({', '.join(f"coalesce({d}, 'SIN_DATO') AS {d}" for d in _DIMS)}) FROM auth)
SELECT {_dim_name} AS dimension, {_dim_val} AS valor,
       count(*) AS filas, count(DISTINCT project_key) AS proyectos,
       count(DISTINCT CASE WHEN has_benefits THEN project_key END) AS proyectos_promovidos,
       count(*) FILTER (WHERE es_ampliacion) AS ampliaciones,
       round(coalesce(sum(monto_ui_beneficios), 0.0), 2) AS monto_ui_beneficios,
       round(coalesce(sum(monto_ui_presentado), 0.0), 2) AS monto_ui_presentado
FROM a GROUP BY GROUPING SETS ({', '.join(f'({d})' for d in _DIMS)}, ())""")
def q_metric_registry(spark, sf_dir):
    return deck.metric_registry(_auth(spark, sf_dir), dimensions=_DIMS)


# ---- A6 opt-in: estimates from stored sketches, next to the exact counts ------------
@register("sketched_projects", f"""WITH {O.linkage_cte()},
a AS (SELECT * REPLACE ({', '.join(f"coalesce({d}, 'SIN_DATO') AS {d}" for d in _DIMS)}) FROM auth)
SELECT {_dim_name} AS dimension, {_dim_val} AS valor, count(*) AS filas, count(DISTINCT project_key) AS proyectos,
       count(DISTINCT CASE WHEN has_benefits THEN project_key END) AS proyectos_promovidos, TRUE AS dentro_del_error
FROM a GROUP BY GROUPING SETS ({', '.join(f'({d})' for d in _DIMS)}, ())""")
def q_sketched_projects(spark, sf_dir):
    auth, levels = materialize(_auth(spark, sf_dir).select("project_key", "has_benefits", *_DIMS)), [[d] for d in _DIMS] + [[]]  # read twice
    estimate = deck.merged_projects(deck.project_sketches(auth, _DIMS), _DIMS, levels)
    counted = deck.by_level(auth.withColumns({d: F.coalesce(d, F.lit("SIN_DATO")) for d in _DIMS}), _DIMS, levels, {"filas": F.lit(1).cast("bigint")})
    e, c = estimate.alias("e"), counted.alias("c")
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"c.{k}")) for k in ("_level", *_DIMS)]
    near = [F.abs(F.col(f"e.{k}") - F.col(f"c.{k}")) <= F.ceil(F.col(f"c.{k}") * deck.sketch_error()) for k in ("proyectos", "proyectos_promovidos")]
    return c.join(e, same).select(
        F.element_at(F.array(*[F.lit(d) for d in _DIMS], F.lit("total")), F.col("c._level") + 1).alias("dimension"),
        F.coalesce(*[F.col(f"c.{d}") for d in _DIMS], F.lit("total")).alias("valor"), "e.filas", "c.proyectos", "c.proyectos_promovidos",
        (near[0] & near[1]).alias("dentro_del_error"))


# ---- S8 D11: one publication of all tables -------------------------------------
@register("published_audit", f"""WITH {O.linkage_cte()}
SELECT match_method, source, count(*) AS rows FROM auth GROUP BY match_method, source""")
def q_published_audit(spark, sf_dir):
    auth = materialize(_auth(spark, sf_dir).select(
        "match_method", "source", "ministerio_evaluador", "project_key", "es_ampliacion", "has_benefits",
        "monto_ui_beneficios", "monto_ui_presentado"))  # what the two tables are made of
    folder = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    sinks.publish({"linkage_audit": reports.linkage_audit(auth), "summary": reports.summary_by_group(auth)}, folder)
    return sinks.read_published(spark, folder, "linkage_audit", verify=True)


# ---- W1 -------------------------------------------------------------------
@register("stable_row_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row_id
FROM lineitem""")
def q_stable_row_ids(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dense_row_ids(table(spark, sf_dir, "lineitem", cols), cols, "row_id")


# ---- U2 -------------------------------------------------------------------
@register("union_by_name", """
SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_nationkey AS nationkey,
       c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def q_union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("source"))
    return c.unionByName(s, allowMissingColumns=True)


# ---- S1 S2 S3 S11 D6 D7 -----------------------------------------------------
# Paths built from the page addresses: the address's folders, then a file name of one kind per remainder of the id.
_NAMES = ["Presentados_{}.xlsx", "sub/RECOMENDADOS {}.XLSM", "~$Presentados_{}.xlsx", "otros-{}.xls", "presentados {}.xls",
          "Lista recomendados y presentados {}.xlsx", "presentados_{}.csv", "processed/recomendados_{}.xlsx"]
_OUTPUT = "/processed/"


def _path_spark():
    name = F.replace(F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("page_id") % len(_NAMES) + 1).cast("int")),
                     F.lit("{}"), F.col("page_id").cast("string"))
    return F.concat(F.regexp_replace("url", "[?#].*", ""), F.lit("/"), name)


def _path_sql() -> str:
    names = ", ".join(map(O.q, _NAMES))
    return (f"regexp_replace(url, '[?#].*', '') || '/' || replace([{names}][page_id % {len(_NAMES)} + 1], '{{}}', "
            "CAST(page_id AS VARCHAR))")


_norm = O.norm_name("file_name")


@register("file_classification", f"""WITH p AS (SELECT {_path_sql()} AS path FROM pages),
f AS (SELECT path, string_split(path, '/')[-1] AS file_name, len(string_split(path, '/')) - 1 AS depth FROM p),
d AS (SELECT *, regexp_matches(file_name, '(?i)[.]xls[xm]?$') AS is_workbook, starts_with(file_name, '~$') AS is_lock_file,
             contains(path, '{_OUTPUT}') AS in_output_dir,
             contains({_norm}, 'presentad')::INT + contains({_norm}, 'recomend')::INT AS n_datasets FROM f)
SELECT path, file_name, depth, is_workbook, is_lock_file, in_output_dir, n_datasets,
       CASE WHEN NOT is_workbook THEN 'not_a_workbook' WHEN is_lock_file THEN 'lock_file' WHEN in_output_dir THEN 'output_dir'
            WHEN n_datasets = 0 THEN 'unclassified' WHEN regexp_matches(file_name, '(?i)[.]xls$') THEN 'unsupported_format'
            ELSE 'selected' END AS status
FROM d""")
def q_file_classification(spark, sf_dir):
    paths = table(spark, sf_dir, "pages", ["page_id", "url"]).select(_path_spark().alias("path"))
    c = W.classify_files(paths, _OUTPUT)
    return c.select("path", "file_name", (F.size(F.split("path", "/")) - 1).cast("bigint").alias("depth"), "is_workbook",
                    "is_lock_file", "in_output_dir", F.size("datasets").alias("n_datasets"), "status")


@register("file_inventory")
def q_file_inventory(spark, sf_dir):
    inv = W.inventory(spark, sf_dir, output_dir=sf_dir.rstrip("/") + "/processed")
    return inv.select("path", "file_name", "length", "modificationTime", "is_workbook", "status",
                      F.size("datasets").alias("n_datasets"), F.size("dir_parts").alias("depth"))
