"""Narrowed quantiles, mergeable distinct counts and publications."""

import os
import random

import pytest
from pyspark.sql import functions as F

from regfuse.operators import deck
from regfuse.sources import sinks


def test_narrowed_quantiles_are_exact(spark):
    rng = random.Random(5)
    rows = [("a", rng.lognormvariate(0, 8)) for _ in range(500)] + [("b", 7.0)] * 50 + [(None, float(i % 3)) for i in range(40)]
    rows += [("c", -1e308), ("c", 1e308), ("c", 3.0), ("d", None), ("a", float("nan")), ("a", float("inf"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: tuple(r[k] for k in probs) for r in deck.narrowed_quantiles(df, ["g"], "x", probs, buckets=4, enough=3).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        xs = sorted(x for h, x in rows if h == g and x is not None and abs(x) < float("inf"))
        if xs:
            want[g] = tuple(xs[int((len(xs) - 1) * p)] for p in probs.values())
    assert got == want
    assert deck.narrowed_quantiles(df.where("false"), ["g"], "x", probs).collect() == []


def test_sketches_merge_within_their_error(spark):
    n = 30_000
    auth = spark.range(n).select(
        F.concat(F.lit("k"), F.col("id") % 20_000).alias("project_key"), (F.col("id") % 3 == 0).alias("has_benefits"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("m"), F.col("id") % 5)).alias("m"), (F.col("id") % 2).cast("string").alias("s"))
    cells = deck.project_sketches(auth, ["m", "s"])
    assert cells.count() == 10
    merged = {(r._level, r.m, r.s): (r.filas, r.proyectos, r.proyectos_promovidos) for r in deck.merged_projects(cells, ["m", "s"], [["m"], []]).collect()}
    exact = auth.agg(F.count_distinct("project_key"), F.count_distinct(F.when(F.col("has_benefits"), F.col("project_key")))).first()
    filas, proyectos, promovidos = merged[(1, None, None)]
    assert filas == n and abs(proyectos - exact[0]) <= exact[0] * deck.sketch_error() and abs(promovidos - exact[1]) <= exact[1] * deck.sketch_error()
    assert {k[1] for k in merged if k[0] == 0} == {"SIN_DATO", "m1", "m2", "m3", "m4"}


def two(spark, n):
    return {"a": spark.range(n), "b": spark.createDataFrame([(1, "ñ", None, 1.5)] * n, "i int, t string, u string, d double")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_that_ends_between_tables_leaves_the_former_publication(spark, tmp_path, fmt):
    folder = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        sinks.manifest(spark, folder)
    assert sinks.publish(two(spark, 3), folder, fmt) == {"a": 3, "b": 3}
    broken = two(spark, 9)
    broken["b"] = broken["b"].withColumn("d", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, folder, fmt)
    for name in ("a", "b"):
        assert sinks.read_published(spark, folder, name).count() == 3
    assert sinks.publish(two(spark, 5), folder, fmt) == {"a": 5, "b": 5}
    assert sinks.read_published(spark, folder, "a", verify=True).count() == 5


def test_a_changed_table_is_found(spark, tmp_path):
    folder = f"file://{tmp_path}"
    sinks.publish(two(spark, 3), folder)
    place = sinks.manifest(spark, folder)["a"]["path"]
    spark.range(10, 13).write.mode("overwrite").parquet(f"{folder}/{place}")
    with pytest.raises(ValueError, match="not what was published"):
        sinks.read_published(spark, folder, "a", verify=True)
    assert sorted(os.listdir(f"{tmp_path}/_manifests"))[-1].endswith("1.json")
