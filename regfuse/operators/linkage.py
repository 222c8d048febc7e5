"""Tiered linkage of a presented register with a recommended register.

Input registers carry the canonical columns (``REGISTER_COLUMNS``) plus an
ordering column (``order_col``) that stands for "file order": bigint or any
orderable struct, unique within the register.

Tiers for each presented row:

1. ``rut_codigo_tramo``   - a recommended group with the same key and tranche
   has a date;
2. ``rut_codigo_unique``  - no dated tranche match, but the key has exactly one
   recommended row: take that row's attributes;
3. ``rut_codigo_ambiguous`` - the key is recommended, but neither applies;
4. ``presentado_only``    - the key is not recommended (or is NULL).

Recommended rows whose key was never presented become ``recomendado_only``.

Plan shape (why it scales):

* the recommended side is reduced once, at (key, tranche) grain, with map-side
  partial aggregation - a hot key collapses to one row per map task before any
  shuffle; both joins and the key grain read that one reduced exchange;
* the key grain is a second aggregation over the reduced rows (no list or map
  is gathered per key, whatever the number of tranches);
* rows without a key cannot link: in the joins each has a key of its own that no
  other row has, so they are spread like any rows and read in the same pass;
* presented rows are left-joined to each grain.  Every right side has at most
  one row per key and arrives through its own exchange (its key comes out of a
  grouped struct, so it is not taken as already placed), which lets adaptive
  execution split a hot presented key over many tasks;
* "first non-missing in file order" is ``min(struct(order, value))`` filtered
  to valid values - deterministic after any shuffle, no collect of a group.  Rows
  that have all attributes share one such struct, so their order is kept once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTER_COLUMNS = [
    "source_file", "source_path", "source_sheet", "source_header_row", "source_row",
    "rut", "codigo", "empresa", "ministerio_evaluador",
    "fecha_presentado", "fecha_recomendado", "regimen", "tramo", "monto_ui",
    "tramo_clean", "es_ampliacion", "project_key",
]

_FIRST_ATTRS = {
    "regimen": "regimen",
    "monto_ui": "monto_ui",
    "ministerio": "ministerio_evaluador",
}


def _firsts(df: DataFrame, order_col: str) -> list[Column]:
    """Aggregates that ``_first`` reads: ``_whole``, the first row in ``order_col`` order in which no attribute is missing (NULL
    or ``''``), and per attribute ``<name>_rest``, the first of the rows that have it and miss another one."""
    o = F.col(order_col).alias("o")
    valid = {}
    for name, col in _FIRST_ATTRS.items():
        x = F.col(col)
        valid[name] = x.isNotNull() & (x != "") if isinstance(df.schema[col].dataType, T.StringType) else x.isNotNull()
    whole = reduce(lambda a, b: a & b, valid.values())
    return [
        F.min(F.when(whole, F.struct(o, *[F.col(c).alias(k) for k, c in _FIRST_ATTRS.items()]))).alias("_whole"),
        *[F.min(F.when(valid[k] & ~whole, F.struct(o, F.col(c).alias("v")))).alias(f"{k}_rest") for k, c in _FIRST_ATTRS.items()],
    ]


def _first(name: str) -> Column:
    """The attribute's first non-missing value in order, from the columns of ``_firsts``."""
    whole = F.when(F.col("_whole").isNotNull(), F.struct(F.col("_whole.o").alias("o"), F.col(f"_whole.{name}").alias("v")))
    return F.least(whole, F.col(f"{name}_rest")).getField("v")


def tranche_rollup(recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """(project_key, tramo_clean) grain over rows with a key; tranche may be ''."""
    # ``k`` stays a struct in the aggregation, see the module's notes on exchanges
    grouped = (
        recommended.where(F.col("project_key").isNotNull() & F.col("tramo_clean").isNotNull())
        .groupBy(F.struct("project_key", "tramo_clean").alias("k"))
        .agg(
            F.min("fecha_recomendado").alias("fecha_min"),
            *_firsts(recommended, order_col),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    return grouped.select(F.col("k.project_key").alias("project_key"), F.col("k.tramo_clean").alias("tramo_clean"),
                          *[c for c in grouped.columns if c != "k"])


def exact_rollup(recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """Recommended rows aggregated by (key, tranche), blank tranche excluded."""
    return _exact_columns(tranche_rollup(recommended, order_col).where(F.col("tramo_clean") != ""), F.col("tramo_clean"))


def _exact_columns(tranches: DataFrame, tramo: Column, on=("project_key",)) -> DataFrame:
    return tranches.select(
        *on,
        tramo,
        F.col("fecha_min").alias("fecha_recomendado_exact"),
        *[_first(k).alias(f"{k}_recomendado_exact") for k in _FIRST_ATTRS],
        F.col("n_rows").alias("recommended_rows_exact"),
    )


def _key_rollup(tranches: DataFrame, on=("project_key",)) -> DataFrame:
    tc = F.col("tramo_clean")
    grouped = tranches.groupBy(F.struct(*on).alias("k")).agg(
        F.min("fecha_min").alias("fecha_recomendado_project"),
        *[F.min(c).alias(c) for c in ("_whole", *[f"{k}_rest" for k in _FIRST_ATTRS])],
        F.sum("n_rows").alias("recommended_rows_project"),
        F.count_if(tc != "").alias("recommended_tramos"),
    )
    return grouped.select(
        *[F.col(f"k.{c}").alias(c) for c in on], "fecha_recomendado_project",
        *[_first(k).alias(f"{k}_recomendado_project") for k in _FIRST_ATTRS], "recommended_rows_project", "recommended_tramos")


def project_rollup(recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """Recommended rows aggregated by key (all tranches)."""
    return _key_rollup(tranche_rollup(recommended, order_col))


def link_presented(presented: DataFrame, recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """Presented rows with exact / project attributes, the resolved
    recommendation and ``match_method``.  Row count equals ``presented``.

    A blank tranche is no tranche: a presented one is NULL in the exact join and
    matches nothing.  (No filter on the rollup, so that both joins share it.)"""
    tranches = tranche_rollup(recommended, order_col)
    # the key is carried once: ``project_key`` is taken from ``_key`` again after the joins
    j = presented.withColumns({"_key": link_key(order_col), "_tramo": F.nullif(F.col("tramo_clean"), F.lit(""))}).drop("project_key")
    j = with_recommendations(j, tranches, ["_key"]).withColumn("project_key", project_key_of("_key"))
    return resolve_link(j.select(*presented.columns, *[c for c in j.columns if c not in (*presented.columns, "_key", "_tramo")]))


def link_key(*place: str) -> Column:
    """The project key; for a row without one a key that no row has (keys hold no control character), by its ``place``."""
    return F.coalesce(F.col("project_key"), F.concat(F.lit("\u0000"), F.xxhash64(*place).cast("string")))


def project_key_of(link_key: str) -> Column:
    return F.when(~F.col(link_key).startswith("\u0000"), F.col(link_key))


def with_recommendations(rows: DataFrame, tranches: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` (with ``_tramo``) left-joined to the exact and to the key grain of ``tranches``, whose column ``project_key``
    is named ``on[0]`` there; further columns of ``on`` are in both."""
    # always true: with it both grains read these columns, also where only one needs them, and so one and the same exchange
    shared = tranches.where((F.col("n_rows") > 0) | F.col("fecha_min").isNotNull())
    renamed = shared.withColumnRenamed("project_key", on[0])
    exact = _exact_columns(renamed, F.col("tramo_clean").alias("_tramo"), on)
    return rows.join(exact, [*on, "_tramo"], "left").join(_key_rollup(renamed, on), on, "left")


def resolve_link(j: DataFrame) -> DataFrame:
    """The resolved recommendation and ``match_method`` of rows ``with_recommendations``."""
    fallback = F.col("fecha_recomendado_exact").isNull() & (F.col("recommended_rows_project") == 1)
    j = j.withColumn("can_fallback_to_project", fallback)
    fb = F.col("can_fallback_to_project")

    def pick(exact_col: str, project: str) -> Column:
        return F.coalesce(F.col(exact_col), F.when(fb, F.col(project)))

    return j.withColumns(
        {
            "fecha_recomendado": pick("fecha_recomendado_exact", "fecha_recomendado_project"),
            "regimen_recomendado": pick("regimen_recomendado_exact", "regimen_recomendado_project"),
            "monto_ui_recomendado": pick("monto_ui_recomendado_exact", "monto_ui_recomendado_project"),
            "ministerio_recomendado": pick("ministerio_recomendado_exact", "ministerio_recomendado_project"),
            "match_method": F.when(F.col("fecha_recomendado_exact").isNotNull(), F.lit("rut_codigo_tramo"))
            .when(fb, F.lit("rut_codigo_unique"))
            .when(F.col("recommended_rows_project").isNotNull(), F.lit("rut_codigo_ambiguous"))
            .otherwise(F.lit("presentado_only")),
            "source": F.lit("presentado"),
        }
    )


def recommended_only(presented: DataFrame, recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """Recommended rows whose key no presented row has; rows without a key
    always stay (in the join they have a key of their own, by provenance: the order's columns need not be carried for it).

    Such a row is its own recommendation: its values are the resolved ones and
    it counts as the one recommended row of its key."""
    keys = presented.where(F.col("project_key").isNotNull()).select(F.col("project_key").alias("_key"))
    key = link_key("source_sheet", "source_row", "monto_ui")
    rows = recommended.withColumn("_key", key).drop("project_key").join(keys, "_key", "left_anti")
    rows = rows.withColumn("project_key", project_key_of("_key")).select(*recommended.columns)
    return as_own_recommendation(rows)


def as_own_recommendation(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "fecha_presentado": F.lit(None).cast("date"),
            "regimen_recomendado": F.col("regimen"),
            "monto_ui_recomendado": F.col("monto_ui"),
            "ministerio_recomendado": F.col("ministerio_evaluador"),
            "recommended_rows_exact": F.lit(1).cast("bigint"),
            "recommended_rows_project": F.lit(1).cast("bigint"),
            "recommended_tramos": (F.col("tramo_clean") != "").cast("bigint"),
            "match_method": F.lit("recomendado_only"),
            "source": F.lit("recomendado_only"),
        }
    )


def unlinked_recommended(presented: DataFrame, recommended: DataFrame) -> DataFrame:
    """Recommended rows that feed no output row: the key was presented, the
    (key, tranche) pair was not, and the key has more than one recommended row
    (a sole row would have been taken by the unique fallback).

    What holds for a key is decided at key grain, so the rows are exchanged twice: for the key and for the pair."""
    rec = recommended.where(F.col("project_key").isNotNull())
    pres = presented.where(F.col("project_key").isNotNull())
    # a blank tranche never links exactly, even against a blank presented tranche
    pairs = pres.where(F.col("tramo_clean") != "").select("project_key", "tramo_clean")
    both = rec.select("project_key", F.lit(1).alias("_rec")).unionByName(pres.select("project_key", F.lit(0).alias("_rec")))
    per_key = both.groupBy(F.struct("project_key").alias("k")).agg(F.sum("_rec").alias("_n"), F.min("_rec").alias("_least"))
    keys = per_key.where((F.col("_n") > 1) & (F.col("_least") == 0)).select(F.col("k.project_key").alias("project_key"))
    return rec.join(keys, "project_key", "left_semi").join(pairs, ["project_key", "tramo_clean"], "left_anti")
