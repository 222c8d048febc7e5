"""A placed register gives the same links, and its rows are not exchanged."""

import re

import pytest
from pyspark.sql import functions as F

from regfuse.operators import linkage as L
from regfuse.operators import placement as P
from tests.test_linkage_skew import register

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def plain_joins(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("hot", [7, None])
def test_same_rows_without_moving_the_placed_side(plain_joins, tmp_path, hot):
    spark = plain_joins
    pres, rec = register(spark, 6_000, F.lit(hot).cast("bigint")), register(spark, 3_000, F.col("id") % 499, rec=True)
    name = f"placed_{hot or 'none'}"
    placed = P.place(pres, name, f"file://{tmp_path}")
    try:
        linked = P.relink(spark, placed, rec)
        assert rows_of(linked) == rows_of(L.link_presented(pres, rec))
        assert rows_of(P.relinked_only(spark, placed, rec)) == rows_of(L.recommended_only(pres, rec))
        # between the scan of the placed rows and the joins there is no exchange
        plan = linked._jdf.queryExecution().executedPlan().toString().split("\n")
        scan = next(i for i, line in enumerate(plan) if re.search(rf"Scan parquet .*{name}\[|Scan parquet .*{name}\b(?!_)", line) and "empresa" in line)
        depth, above = len(plan[scan]) - len(plan[scan].lstrip(" :+-*()0123456789")), []
        for line in reversed(plan[:scan]):
            d = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if d < depth:
                depth = d
                above.append(line)
        assert sum("SortMergeJoin" in line for line in above) == 2, above
        assert not any("Exchange" in line for line in above), above
        # a key with three quarters of the rows does not fill one bucket
        sizes = [r["n"] for r in spark.table(placed.rows).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 6_000 and max(sizes) < 3_000
    finally:
        P.remove_placed(spark, placed)


def test_empty_register(plain_joins, tmp_path):
    spark = plain_joins
    pres, rec = register(spark, 0, F.lit(1)), register(spark, 50, F.col("id") % 7, rec=True)
    placed = P.place(pres, "placed_empty", f"file://{tmp_path}")
    assert P.relink(spark, placed, rec).count() == 0
    assert P.relinked_only(spark, placed, rec).count() == 50
    P.remove_placed(spark, placed)
