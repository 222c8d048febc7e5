"""Hot and NULL keys on the presented side: the same rows, spread over many tasks, one scan of the recommended register."""

import pytest
from pyspark.sql import functions as F

from regfuse.operators.linkage import link_presented
from regfuse.operators.register import standardize


def register(spark, n, hot, rec=False):
    k = F.when(F.col("id") % 4 != 0, hot).otherwise(F.col("id") % 500)
    df = spark.range(0, n, 1, 24)
    return standardize(
        df, rut=k, codigo=F.lit("c"), empresa=F.concat(F.lit("company with a long enough name "), F.col("id")),
        tramo=F.when(F.col("id") % 2 == 0, "a").otherwise("b"), monto_ui=F.col("id").cast("double"),
        fecha_recomendado=F.lit("2020-01-01").cast("date") if rec else None, order=F.col("id"),
    )


@pytest.mark.parametrize("hot", [7, None])
def test_hot_key_is_split(spark, hot, tmp_path):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        register(spark, 60_000, F.lit(hot).cast("bigint")).write.parquet(f"{tmp_path}/p")
        register(spark, 2_000, F.col("id") % 499, rec=True).write.parquet(f"{tmp_path}/r")
        linked = link_presented(spark.read.parquet(f"{tmp_path}/p"), spark.read.parquet(f"{tmp_path}/r"))
        linked.write.parquet(f"{tmp_path}/out")
        parts = [r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy(F.input_file_name()).count().collect()]
        assert sum(parts) == 60_000
        assert max(parts) < 20_000, sorted(parts)[-5:]  # three quarters of the rows share one key
        linked.collect()
        plan = linked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
