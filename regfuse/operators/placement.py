"""The presented register placed by key, so that linking it again moves only the recommended side.

``place`` writes the register once as a table in buckets of (link key, salt), and its keys as a second table.  ``relink`` joins
the placed rows to the rollups of any recommended register: both joins read the buckets as they are, and only the rollups (a
row per key and tranche) are exchanged.  The recommended-only branch reads the placed keys, also as they are.

A key with more rows than a fair bucket is *hot*: its rows are dealt over as many salts as they fill buckets, and the rollup's
rows of that key are repeated for each salt.  There are fewer hot keys than buckets (their rows would not fit otherwise), so
the table of hot keys is small whatever the size of the register; a row without a key has a key of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.operators import linkage as L

_ON = ["_key", "_salt"]


@dataclass(frozen=True)
class Placed:
    """Names of the tables of a placed register, and the number of buckets."""

    rows: str
    keys: str
    hot: str
    buckets: int


def place(presented: DataFrame, name: str, folder: str | None = None, buckets: int | None = None, order_col: str = "_order") -> Placed:
    """Write ``presented`` as bucketed tables ``name``, ``name_keys`` and ``name_hot`` (under ``folder``, by default in the
    warehouse).  ``buckets``: at least the session's shuffle partitions, else Spark would deal the buckets out again."""
    spark = presented.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = Placed(name, f"{name}_keys", f"{name}_hot", max(shuffle, buckets or shuffle))

    def save(df: DataFrame, table: str, by: list[str]) -> None:
        writer = df.repartition(placed.buckets, *by).write.mode("overwrite").format("parquet")  # a file a bucket
        writer = writer.option("path", f"{folder.rstrip('/')}/{table}") if folder else writer
        writer.bucketBy(placed.buckets, *by).sortBy(*by).saveAsTable(table)

    keyed = presented.where(F.col("project_key").isNotNull())
    save(keyed.groupBy(F.col("project_key").alias("_key")).agg(F.count(F.lit(1)).alias("_rows")), placed.keys, ["_key"])
    keys = spark.table(placed.keys)
    fair = F.lit(max(1, (keys.agg(F.sum("_rows")).first()[0] or 0) // placed.buckets))
    hot = keys.where(F.col("_rows") > fair).select("_key", F.ceil(F.col("_rows") / fair).cast("int").alias("_salts"))
    writer = hot.coalesce(1).write.mode("overwrite").format("parquet")  # fewer rows than buckets
    (writer.option("path", f"{folder.rstrip('/')}/{placed.hot}") if folder else writer).saveAsTable(placed.hot)
    rows = presented.withColumn("_key", L.link_key(order_col)).join(F.broadcast(spark.table(placed.hot)), "_key", "left")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(order_col), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    save(rows, placed.rows, _ON)
    return placed


def remove_placed(spark: SparkSession, placed: Placed) -> None:
    """Forget the tables (files in a folder of the caller's stay)."""
    for table in (placed.rows, placed.keys, placed.hot):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which a join on (key, salt, tranche) takes rows placed by (key, salt)."""
    own = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
              "spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
        if spark.conf.get(k, None) is not None:
            own.conf.set(k, spark.conf.get(k))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def relink(spark: SparkSession, placed: Placed, recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """The same rows as ``linkage.link_presented``."""
    own = _session(spark)
    tranches = L.tranche_rollup(recommended, order_col).withColumnRenamed("project_key", "_key")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    tranches = tranches.join(F.broadcast(own.table(placed.hot)), "_key", "left").withColumn("_salt", salts).drop("_salts")
    rows = own.table(placed.rows).withColumn("_tramo", F.nullif(F.col("tramo_clean"), F.lit("")))
    joined = L.with_recommendations(rows, tranches.withColumnRenamed("_key", "project_key"), _ON)
    return L.resolve_link(joined.drop("_tramo", *_ON))


def relinked_only(spark: SparkSession, placed: Placed, recommended: DataFrame, order_col: str = "_order") -> DataFrame:
    """The same rows as ``linkage.recommended_only``."""
    keys = _session(spark).table(placed.keys).select("_key")
    rows = recommended.withColumn("_key", L.link_key(order_col)).join(keys, "_key", "left_anti").drop("_key")
    return L.as_own_recommendation(rows)
