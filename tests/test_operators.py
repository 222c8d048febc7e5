"""Operator-level checks: joins to small tables, dense ids, exact quantiles."""

from pyspark.sql import functions as F

from regfuse.operators.deck import exact_quantiles
from regfuse.operators.joins import join_small
from regfuse.operators.rowid import dense_row_ids


def test_join_small_keeps_every_row(spark):
    big = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit("hot.xlsx")).otherwise(F.concat(F.lit("f"), (F.col("id") % 7).cast("string"))).alias("source_path"),
        F.lit("Hoja1").alias("source_sheet"),
        F.col("id").alias("row_idx"),
    )
    small = big.select("source_path", "source_sheet").distinct().withColumn("header_row", F.length("source_path"))
    a = join_small(big, small, ["source_path", "source_sheet"])
    assert a.count() == 20000 and a.where("header_row <> length(source_path)").count() == 0


def test_dense_row_ids_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    got = dense_row_ids(df, ["g", "k"], "rid", num_partitions=6)
    rows = sorted((r.g, r.k, r.rid) for r in got.collect())
    assert [r[2] for r in rows] == list(range(1, 5001))


def test_exact_quantiles_discrete(spark):
    df = spark.createDataFrame([("a", v) for v in [5, 1, 3, 3, 9, 7]] + [("b", 4)], "g string, v int")
    q = {r.g: (r.med, r.p90) for r in exact_quantiles(df, ["g"], "v", {"med": 0.5, "p90": 0.9}).collect()}
    # a sorted: 1 3 3 5 7 9 -> pos floor(5*0.5)=2 -> 3 ; floor(5*0.9)=4 -> 7
    assert q == {"a": (3, 7), "b": (4, 4)}
