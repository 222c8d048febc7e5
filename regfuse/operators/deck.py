"""Indicators the project decks ask for, defined over the authoritative table.

All are plain aggregations / joins on ``authoritative`` (or a register):
nothing is collected to the driver and no group is gathered into one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regfuse.session import materialize


def _g(col: str, missing: str = "SIN_DATO") -> Column:
    return F.coalesce(F.col(col), F.lit(missing))


def by_level(df: DataFrame, dims: list[str], levels: list[list[str]], sums: dict[str, Column]) -> DataFrame:
    """Projects and summed measures for every combination of ``levels`` (each a
    subset of ``dims``), with the level's place in the list as ``_level``.

    Rows are first reduced to (dimensions, project) grain; only those are
    repeated per level, and reduced again, so that distinct projects are plain
    counts.  They are placed by project before they are repeated (a project, or
    no project, has a row per combination of dimensions by then), so what is
    repeated is not exchanged.  ``proyectos``: distinct keys; ``proyectos_promovidos``: those with
    a row that has benefits; the ``sums`` are added up."""
    reduced = df.groupBy(*dims, "project_key").agg(
        F.max("has_benefits").alias("_promoted"), *[F.sum(c).alias(k) for k, c in sums.items()]
    )
    none = {d: F.lit(None).cast(df.schema[d].dataType) for d in dims}
    marks = [
        F.struct(F.lit(i).alias("_level"), *[(F.col(d) if d in level else none[d]).alias(d) for d in dims])
        for i, level in enumerate(levels)
    ]
    spread = reduced.repartition("project_key").select("project_key", "_promoted", *sums, F.explode(F.array(*marks)).alias("_m"))
    spread = spread.select("project_key", "_promoted", *sums, "_m.*")
    keyed = spread.groupBy("_level", *dims, "project_key").agg(
        F.max("_promoted").alias("_promoted"), *[F.sum(k).alias(k) for k in sums]
    )
    return keyed.groupBy("_level", *dims).agg(
        F.count("project_key").alias("proyectos"),
        F.count_if(F.col("_promoted") & F.col("project_key").isNotNull()).alias("proyectos_promovidos"),
        *[F.sum(k).alias(k) for k in sums],
    )


# ---- D1 -------------------------------------------------------------------
def promoted_projects(auth: DataFrame, by: str = "ministerio_evaluador") -> DataFrame:
    """Distinct projects with benefits, per ``by`` value and overall
    (``is_total`` marks the overall row)."""
    rows = auth.withColumn(by, _g(by))
    out = by_level(rows, [by], [[by], []], {"filas_con_beneficios": F.col("has_benefits").cast("bigint")})
    return out.select(by, "proyectos_promovidos", "filas_con_beneficios", "proyectos", (F.col("_level") == 1).alias("is_total"))


# ---- D2 -------------------------------------------------------------------
def approval_days(auth: DataFrame) -> DataFrame:
    """Rows with both dates and the days from presentation to recommendation."""
    return auth.where(F.col("fecha_presentado").isNotNull() & F.col("fecha_recomendado").isNotNull()).withColumn(
        "dias", F.datediff("fecha_recomendado", "fecha_presentado")
    )


def exact_quantiles(df: DataFrame, group_cols, value: str, probs) -> DataFrame:
    """Exact discrete quantiles (value at 0-based position floor((n-1)p) in
    ascending order) without gathering a group: a histogram of
    (group, value) counts - bounded by the distinct values - and running
    counts over it."""
    hist = df.groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    wt = Window.partitionBy(*group_cols)
    hist = hist.withColumn("_cum", F.sum("_c").over(w)).withColumn("_n", F.sum("_c").over(wt))
    aggs = []
    for name, p in probs.items():
        pos = F.floor((F.col("_n") - 1) * F.lit(p))
        aggs.append(F.min(F.when(F.col("_cum") > pos, F.col(value))).alias(name))
    return hist.groupBy(*group_cols).agg(*aggs)


def narrowed_quantiles(df: DataFrame, group_cols: list[str], value: str, probs: dict[str, float],
                       buckets: int = 1024, enough: int = 10_000) -> DataFrame:
    """Exact discrete quantiles (as ``exact_quantiles``) of values that need not repeat, such as amounts: a column per
    probability, NULL groups included; NULL and non-finite values are left out.

    Distributed selection by narrowing ranges: for every (group, probability) the rows of its range are counted in
    ``buckets`` parts of it, the part that holds the wanted position becomes the range (from its least to its greatest
    value), until the range is one value or holds ``enough`` rows.  A round is one aggregation with partial counts; no task
    ever holds a group, and what is kept between rounds is a row per group and probability."""
    group = F.struct(*group_cols).alias("_g")
    finite = F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") < float("inf"))
    v = materialize(df.select(group, F.col(value).cast("double").alias("_x")).where(finite))
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in probs.items()]))
    state = v.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    state = state.select("_g", "_n", "_lo", "_hi", wanted.alias("_w"))
    # _rank: the position within the range, from 0; _n: the rows of the range
    state = state.select("_g", F.col("_w.name").alias("_name"), F.floor((F.col("_n") - 1) * F.col("_w.p")).alias("_rank"), "_n", "_lo", "_hi")
    state = materialize(state)
    open_ = (F.col("_lo") < F.col("_hi")) & (F.col("_n") > enough)
    upto = Window.partitionBy("_g", "_name").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)  # ``buckets`` rows at most
    while not state.where(open_).isEmpty():
        rows = v.join(state.where(open_).drop("_n"), "_g").where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
        share = (F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)  # halves, against overflow
        rows = rows.withColumn("_b", F.least(F.floor(share * buckets), F.lit(buckets - 1)))
        parts = rows.groupBy("_g", "_name", "_rank", "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        parts = parts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        parts = parts.where(F.col("_rank").between(F.col("_before"), F.col("_before") + F.col("_n") - 1))
        narrowed = parts.select("_g", "_name", (F.col("_rank") - F.col("_before")).alias("_rank"), "_n", "_lo", "_hi")
        state = materialize(narrowed.unionByName(state.where(~open_)))
    ends = state.where(F.col("_lo") == F.col("_hi")).select("_g", "_name", F.col("_lo").alias("_x"))
    few = v.join(state.where(F.col("_lo") < F.col("_hi")), "_g").where(F.col("_x").between(F.col("_lo"), F.col("_hi")))
    place = F.row_number().over(Window.partitionBy("_g", "_name").orderBy("_x")) - 1  # ``enough`` rows at most
    few = few.withColumn("_at", place).where(F.col("_at") == F.col("_rank")).select("_g", "_name", "_x")
    found = ends.unionByName(few).groupBy("_g").pivot("_name", list(probs)).agg(F.first("_x"))
    return found.select("_g.*", *probs)


def amount_quantiles(auth: DataFrame, by: str = "ministerio_evaluador", amount: str = "monto_ui_presentado", enough: int = 10_000) -> DataFrame:
    """Median, 90th and 99th percentile of an amount per group."""
    return narrowed_quantiles(auth.select(_g(by).alias(by), amount), [by], amount, {"mediana": 0.5, "p90": 0.9, "p99": 0.99}, enough=enough)


def approval_time(auth: DataFrame, by: str = "ministerio_evaluador") -> DataFrame:
    """n, mean, median and p90 of days to recommendation per group; negative
    spans (recommended before presented) are counted apart and left out.

    One pass: a histogram of (group, days), from which all figures follow.  It
    has a row per distinct number of days, so its running counts are short."""
    rows = approval_days(auth.select(by, "fecha_presentado", "fecha_recomendado")).withColumn(by, _g(by))
    hist = rows.groupBy(by, "dias").agg(F.count(F.lit(1)).alias("_c"))
    ok = F.col("dias") >= 0
    c = F.when(ok, F.col("_c")).otherwise(0)
    upto = Window.partitionBy(by).orderBy("dias").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumns({"_cum": F.sum(c).over(upto), "_n": F.sum(c).over(Window.partitionBy(by))})

    def quantile(p):
        return F.min(F.when(ok & (F.col("_cum") > F.floor((F.col("_n") - 1) * F.lit(p))), F.col("dias")))

    return hist.groupBy(by).agg(
        F.sum(F.when(~ok, F.col("_c")).otherwise(0)).alias("negativos"),
        F.sum(c).alias("n"),
        F.round(F.sum(F.when(ok, F.col("dias") * F.col("_c"))) / F.sum(F.when(ok, F.col("_c"))), 4).alias("media_dias"),
        quantile(0.5).alias("mediana_dias"),
        quantile(0.9).alias("p90_dias"),
    )


# ---- A6 as an opt-in: mergeable distinct counts ------------------------------
SKETCH_LG_K = 14


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    """Relative error that a merged sketch keeps in 99.7 % of cases: three standard errors of 1.04 / sqrt(2^lg_k)."""
    return 3 * 1.04 / (2**lg_k) ** 0.5


def project_sketches(auth: DataFrame, dims: list[str], lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A row per combination of ``dims``, to be stored: row count and sketches of the distinct projects and of those
    with benefits.  Later levels and periods merge these rows and never read the register again."""
    promoted = F.when(F.col("has_benefits"), F.col("project_key"))
    return auth.withColumns({d: _g(d) for d in dims}).groupBy(*dims).agg(
        F.count(F.lit(1)).alias("filas"),
        F.hll_sketch_agg("project_key", lg_k).alias("proyectos_sketch"), F.hll_sketch_agg(promoted, lg_k).alias("promovidos_sketch"))


def merged_projects(cells: DataFrame, dims: list[str], levels: list[list[str]]) -> DataFrame:
    """Estimated distinct projects of every level (a subset of ``dims``) from stored cells: ``_level``, dims, filas,
    proyectos, proyectos_promovidos."""
    marks = [F.struct(F.lit(i).alias("_level"), *[(F.col(d) if d in level else F.lit(None).cast("string")).alias(d) for d in dims])
             for i, level in enumerate(levels)]
    spread = cells.select("filas", "proyectos_sketch", "promovidos_sketch", F.explode(F.array(*marks)).alias("_m"))
    return spread.groupBy("_m").agg(
        F.sum("filas").alias("filas"),
        F.hll_sketch_estimate(F.hll_union_agg("proyectos_sketch")).alias("proyectos"),
        F.hll_sketch_estimate(F.hll_union_agg("promovidos_sketch")).alias("proyectos_promovidos"),
    ).select("_m.*", "filas", "proyectos", "proyectos_promovidos")


# ---- D3 -------------------------------------------------------------------
def approval_time_rollup(auth: DataFrame, date_col: str = "fecha_presentado") -> DataFrame:
    """Projects, promoted projects, amounts and mean days by year / quarter /
    month of ``date_col``, with subtotals; rows without the date are a group of
    their own (year, quarter and month NULL), so the total counts every row.
    ``nivel``: 0 month, 1 quarter, 3 year, 7 total."""
    days = F.datediff("fecha_recomendado", "fecha_presentado")
    rows = auth.select(
        F.year(date_col).alias("anio"), F.quarter(date_col).alias("trimestre"), F.month(date_col).alias("mes"),
        "project_key", "has_benefits", "monto_ui_beneficios", F.when(days >= 0, days).alias("_dias"),
    )
    dims = ["anio", "trimestre", "mes"]
    sums = {"filas": F.lit(1).cast("bigint"), "monto": F.col("monto_ui_beneficios"), "dias": F.col("_dias"),
            "con_dias": F.col("_dias").isNotNull().cast("bigint")}
    out = by_level(rows, dims, [dims, dims[:2], dims[:1], []], sums)
    return out.select(
        *dims, "filas", "proyectos", "proyectos_promovidos",
        F.round(F.coalesce("monto", F.lit(0.0)), 2).alias("monto_ui_beneficios"),
        F.round(F.col("dias") / F.nullif("con_dias", F.lit(0)), 4).alias("media_dias"),
        F.element_at(F.array(F.lit(0), F.lit(1), F.lit(3), F.lit(7)), F.col("_level") + 1).cast("bigint").alias("nivel"),
    )


# ---- D4 -------------------------------------------------------------------
def register_ledger(register: DataFrame, auth: DataFrame | None = None, by: str = "source_file") -> DataFrame:
    """Per source file (named by the column ``by``): rows kept, rows with a key, duplicated (key, tranche)
    rows (they repeat the same recommendation, see the summary caveat) and,
    when ``auth`` is given, output rows per match method."""
    dup = (
        register.where(F.col("project_key").isNotNull())
        .groupBy(by, "project_key", "tramo_clean")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(by)
        .agg(F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("filas_clave_duplicada"))
    )
    base = register.groupBy(by).agg(
        F.count(F.lit(1)).alias("filas"),
        F.count("project_key").alias("filas_con_clave"),
        F.count_distinct("project_key").alias("claves"),
    )
    out = base.join(dup, by, "left").fillna(0, ["filas_clave_duplicada"])
    if auth is not None:
        methods = ["rut_codigo_tramo", "rut_codigo_unique", "rut_codigo_ambiguous", "presentado_only", "recomendado_only"]
        m = auth.groupBy(by).pivot("match_method", methods).agg(F.count(F.lit(1)))
        out = out.join(m, by, "left").fillna(0, methods)
    return out


def form_ledger(inv: DataFrame, errors: DataFrame, chosen: DataFrame, pres: DataFrame, rec: DataFrame,
                auth: DataFrame) -> DataFrame:
    """Per discovered file: status, datasets, decode error, chosen sheet,
    header row and scores, rows kept per dataset, output rows per method.
    Files are told apart by their path (``auth`` carries ``source_path``)."""
    files = inv.select(F.col("path").alias("source_path"), "file_name", "status", "datasets", "length",
                       "modificationTime")
    files = files.join(errors, "source_path", "left")
    sheets = chosen.groupBy("source_path").agg(
        F.collect_list(F.struct("dataset", "source_sheet", "header_row", "header_score", "sheet_score")).alias("hojas")
    )
    kept = pres.select("source_path").withColumn("ds", F.lit("presentados")).unionByName(
        rec.select("source_path").withColumn("ds", F.lit("recomendados"))
    )
    kept = kept.groupBy("source_path").pivot("ds", ["presentados", "recomendados"]).agg(F.count(F.lit(1)))
    columns = ["source_path", "project_key", "tramo_clean"]
    per_method = register_ledger(pres.select(*columns).unionByName(rec.select(*columns)), auth, by="source_path")
    out = files.join(sheets, "source_path", "left").join(kept, "source_path", "left")
    return out.join(per_method.drop("filas"), "source_path", "left")


# ---- D5 -------------------------------------------------------------------
def drill_through(auth: DataFrame, by: str = "ministerio_evaluador", only_benefits: bool = True) -> DataFrame:
    """The rows behind every summary cell: group value -> (file, sheet, row)."""
    a = auth.withColumn(by, _g(by))
    if only_benefits:
        a = a.where(F.col("has_benefits"))
    return a.select(by, "project_row_id", "project_key", "match_method", "source_file", "source_sheet", "source_row")


# ---- D8 -------------------------------------------------------------------
def schema_versions(chosen: DataFrame) -> DataFrame:
    """Layout fingerprint per chosen sheet (hash of its sorted field ->
    column-name pairs) and how many workbooks share each layout."""
    pairs = F.array_sort(F.transform("resolved", lambda r: F.concat_ws("=", r["field"], r["column_name"])))
    fp = chosen.select("dataset", "source_path", pairs.alias("layout"))
    fp = fp.withColumn("fingerprint", F.xxhash64(F.concat_ws("|", "layout")))
    return fp.groupBy("dataset", "fingerprint", "layout").agg(
        F.count(F.lit(1)).alias("libros"), F.min("source_path").alias("ejemplo")
    )


# ---- D9 -------------------------------------------------------------------
def key_sample(df: DataFrame, buckets: int, bucket: int = 0, key: str = "project_key") -> DataFrame:
    """Deterministic sample that keeps every row of a key together: rows whose
    key falls into ``bucket`` of ``buckets`` by the first 32 bits of its md5;
    rows without a key are sampled by their own provenance so they are not all
    in or all out."""
    k = F.coalesce(F.col(key), F.concat_ws("#", "source_file", "source_sheet", F.col("source_row").cast("string")))
    return df.where(F.conv(F.left(F.md5(k), F.lit(8)), 16, 10).cast("bigint") % buckets == bucket)


# ---- D10 ------------------------------------------------------------------
def company_lookup(df: DataFrame, term: str) -> DataFrame:
    """Rows whose company name contains ``term`` (accent/case/punctuation
    insensitive) or whose id equals the digits of ``term``."""
    from regfuse.functions.text import normalize_name as nn

    norm_term = F.regexp_replace(
        F.regexp_replace(F.lower(F.translate(F.lit(term), *_translit())), "[^a-z0-9]+", "_"), "^_|_$", ""
    )
    digits = F.nullif(F.regexp_replace(F.lit(term), "[^0-9]", ""), F.lit(""))
    name_hit = F.coalesce(nn("empresa").contains(norm_term), F.lit(False))
    id_hit = F.coalesce(F.col("rut") == digits, F.lit(False))
    return df.where(name_hit | id_hit)


def _translit():
    from regfuse.functions.constants import TRANSLIT_FROM, TRANSLIT_TO

    return TRANSLIT_FROM, TRANSLIT_TO


def company_profile(auth: DataFrame) -> DataFrame:
    """Per company id: name, projects, rows, benefits, amounts, first / last dates."""
    hb = F.col("has_benefits")
    return auth.where(F.col("rut").isNotNull()).groupBy("rut").agg(
        F.min("empresa").alias("empresa"),
        F.count(F.lit(1)).alias("filas"),
        F.count_distinct("project_key").alias("proyectos"),
        F.count_distinct(F.when(hb, F.col("project_key"))).alias("proyectos_con_beneficios"),
        F.round(F.coalesce(F.sum("monto_ui_presentado"), F.lit(0.0)), 2).alias("monto_ui_presentado"),
        F.round(F.coalesce(F.sum("monto_ui_beneficios"), F.lit(0.0)), 2).alias("monto_ui_beneficios"),
        F.min("fecha_presentado").alias("primera_presentacion"),
        F.max("fecha_presentado").alias("ultima_presentacion"),
        F.max("fecha_recomendado").alias("ultima_recomendacion"),
    )


# ---- D12 ------------------------------------------------------------------
# --- fixed values: default indicator matrix (name -> row expression that is summed) ---
DEFAULT_METRICS = {
    "filas": "1L",
    "ampliaciones": "cast(es_ampliacion AS bigint)",
    "monto_ui_beneficios": "monto_ui_beneficios",
    "monto_ui_presentado": "monto_ui_presentado",
}


def metric_registry(auth: DataFrame, metrics: dict[str, str] | None = None,
                    dimensions=("ministerio_evaluador", "match_method", "regimen")) -> DataFrame:
    """Every registered metric for each dimension alone and overall; long
    output: one row per (dimension, value) with one column per metric, besides
    the distinct projects and promoted projects (see ``by_level``).  Sums of
    fractions are rounded to cents, missing ones are 0."""
    metrics = metrics or DEFAULT_METRICS
    dims = list(dimensions)
    rows = auth.withColumns({d: _g(d) for d in dims})
    out = by_level(rows, dims, [[d] for d in dims] + [[]], {k: F.expr(e) for k, e in metrics.items()})
    names = F.array(*[F.lit(d) for d in dims], F.lit("total"))
    kinds = dict(out.dtypes)

    def shown(k):
        return F.round(F.coalesce(k, F.lit(0.0)), 2) if kinds[k] == "double" else F.coalesce(k, F.lit(0).cast("bigint"))

    return out.select(
        F.element_at(names, F.col("_level") + 1).alias("dimension"), F.coalesce(*dims, F.lit("total")).alias("valor"),
        "proyectos", "proyectos_promovidos", *[shown(k).alias(k) for k in metrics],
    )
