"""The authoritative table made slice by slice: the same rows and ids as in one go, and nothing left on disk but the table."""

import os

import pytest
from pyspark.sql import functions as F

from regfuse.operators import consolidate
from regfuse.operators.register import standardize
from regfuse.plans import catalog
from regfuse.session import checkpoint_dir, ensure_conf

SF = "/root/testdata/sf0.001"
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def joined(spark):
    """Joins exchange both sides."""
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def registers(spark, n=3000):
    """Keys that repeat, are missing, and are only presented or only recommended; blank tranches."""
    i, day = F.col("id"), F.lit("2020-01-01").cast("date")
    p = spark.range(n).select(
        (i * 7919 % n).alias("o"), F.when(i % 5 != 0, i % (n // 2)).alias("k"), F.when(i % 3 == 0, "a").when(i % 3 == 1, "b").alias("t"))
    r = spark.range(2 * n).select(
        (i * 7919 % (2 * n)).alias("o"), F.when(i % 7 != 0, i % n).alias("k"), F.when(i % 2 == 0, "a").alias("t"), F.when(i % 4 != 0, i.cast("double")).alias("m"))
    return (
        standardize(p, rut=F.col("k"), codigo=F.lit("c"), empresa=F.lit("e"), tramo=F.col("t"), fecha_presentado=day, monto_ui=F.col("o").cast("double"),
                    source_file=F.lit("p"), source_path=F.lit("d/p"), source_row=F.col("o"), order=F.col("o")),
        standardize(r, rut=F.col("k"), codigo=F.lit("c"), empresa=F.lit("e"), tramo=F.col("t"), fecha_recomendado=F.when(F.col("m").isNotNull(), day),
                    ministerio_evaluador=F.lit("m"), monto_ui=F.col("m"), source_file=F.lit("r"), source_path=F.lit("d/r"), source_row=F.col("o"), order=F.struct("o")))


def in_one_go(p, r):
    """Rows with ids from one sort of all rows."""
    u = consolidate.authoritative_columns(consolidate.linked_union(p, r), ("source_path",))
    rows = sorted(u.collect(), key=lambda x: (x._branch, x._order_p if x._branch == 0 else x._order_r.o))
    return [(i, *[x[c] for c in (*consolidate.AUTHORITATIVE_COLUMNS[1:], "source_path")]) for i, x in enumerate(rows, 1)]


@pytest.mark.parametrize("slice_bytes", [0, 1 << 30])
def test_slices_give_the_rows_and_ids_of_one_go(spark, monkeypatch, slice_bytes):
    p, r = registers(spark, 300)
    monkeypatch.setattr(consolidate, "SLICE_BYTES", slice_bytes)
    got = consolidate.authoritative(p, r, sort=False, extra=("source_path",))
    assert got.columns == [*consolidate.AUTHORITATIVE_COLUMNS, "source_path"]
    assert sorted(tuple(x) for x in got.collect()) == in_one_go(p, r)


@pytest.mark.parametrize("empty", ["presented", "recommended", "both"])
def test_empty_registers(spark, empty):
    p, r = registers(spark, 50)
    p, r = p.limit(0) if empty != "recommended" else p, r.limit(0) if empty != "presented" else r
    n = {"presented": 100, "recommended": 50, "both": 0}[empty]
    got = consolidate.authoritative(p, r)
    assert sorted(x.project_row_id for x in got.collect()) == list(range(1, n + 1))


def shuffle_bytes(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = [f"{at}/{f}" for d in dirs for at, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")]
    return {f: os.path.getsize(f) for f in files}


def folder_bytes(spark):
    at = checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(at) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("slice_bytes", [0, 1 << 30])
def test_only_the_table_stays_on_disk(joined, monkeypatch, slice_bytes):
    p, r = registers(joined)
    monkeypatch.setattr(consolidate, "SLICE_BYTES", slice_bytes)
    exchanged, written = shuffle_bytes(joined), folder_bytes(joined)
    auth = consolidate.authoritative(p, r, sort=False)
    left = {f: n for f, n in shuffle_bytes(joined).items() if f not in exchanged}
    assert sum(left.values()) < 20_000, left  # hundreds of KB before; what is left are counts
    table = consolidate.materialize(auth)
    own = sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(table.materialized_path.removeprefix("file:")) for f in names if f.endswith(".parquet"))
    assert folder_bytes(joined) - own - written < 4 * own  # neither the registers nor the rows before they had ids


def test_sort_keeps_values_that_do_not_follow_from_others(spark):
    p, r = registers(spark, 60)
    auth = consolidate.authoritative(p, r, sort=False)
    odd = F.col("project_row_id") % 4
    auth = auth.withColumns({
        "source": F.when(odd == 0, "other").when(odd == 1, F.lit(None)).otherwise(F.col("source")),
        "project_key": F.when(odd == 1, "x::y").when(odd == 2, F.lit(None)).otherwise(F.col("project_key")),
        "has_benefits": F.when(odd == 2, ~F.col("has_benefits")).when(odd == 3, F.lit(None)).otherwise(F.col("has_benefits")),
        "monto_ui_beneficios": F.when(odd == 3, 0.5).when(odd == 0, F.lit(None)).otherwise(F.col("monto_ui_beneficios"))})
    got = consolidate.sort_authoritative(auth)
    assert got.dtypes == auth.dtypes

    def order(x):
        return tuple((x[c] is None, x[c] or "") for c in ("rut", "codigo", "fecha_presentado", "tramo")), x.project_row_id

    assert got.collect() == sorted(auth.collect(), key=order)
    below = got._jdf.queryExecution().optimizedPlan().toString().split("Sort [")[1]
    assert below.count("struct(v, ") >= 4, below  # what follows from others is not exchanged


def test_published_order_leaves_its_rows_only(spark):
    at = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(at))
    out = catalog.QUERIES["published_order"](ensure_conf(spark), SF)
    assert [f"{at}/{d}" for d in os.listdir(at) if d not in before] == [out.materialized_path.removeprefix("file:")]  # five tables before
    rows = out.collect()
    for name in {x.published for x in rows}:
        assert sorted(x.place for x in rows if x.published == name) == list(range(1, sum(x.published == name for x in rows) + 1))
