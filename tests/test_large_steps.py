"""Steps that must not grow faster than the input: what they exchange, write and read, and that their rows stay right."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from regfuse.functions import text as tx
from regfuse.operators import consolidate, deck, linkage, reports, rowid, versions
from regfuse.operators.register import standardize
from regfuse.plans import catalog, queries_deck, queries_forms, queries_linkage
from regfuse.session import ensure_conf, materialize

SF = "/root/testdata/sf0.001"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


@pytest.fixture
def plain(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def recorded(monkeypatch, *modules):
    """The columns of every table that ``modules`` write from now on."""
    seen = []

    def record(df):
        seen.append(df.columns)
        return materialize(df)

    for m in modules:
        monkeypatch.setattr(m, "materialize", record)
    return seen


REC = [  # key, tranche, order, regime, amount, ministry
    (1, "a", 5, "X", 50.0, "m1"), (1, "a", 2, None, 20.0, "m2"), (1, "a", 3, "Y", None, "m3"), (1, "b", 1, " ", None, None),
    (2, "a", 4, None, None, None), (3, "a", 9, "Z", 9.0, "m9"), (3, "a", 6, "W", 6.0, None), (None, "a", 7, "V", 7.0, "m7"),
    (7, "a", 8, "U", 8.0, "m8"), (7, "b", 10, "T", 1.0, "m8"),
]
PRES = [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "a", 4), (None, "a", 5)]


def registers(spark):
    r = spark.createDataFrame(REC, "k int, t string, o int, reg string, m double, mi string")
    p = spark.createDataFrame(PRES, "k int, t string, o int")
    rec = standardize(r, rut=F.col("k"), codigo=F.lit("c"), empresa=F.lit("e"), tramo=F.col("t"), regimen=F.col("reg"), monto_ui=F.col("m"),
                      ministerio_evaluador=F.col("mi"), fecha_recomendado=F.lit("2020-01-01").cast("date"), order=F.col("o"))
    pres = standardize(p, rut=F.col("k"), codigo=F.lit("c"), empresa=F.lit("e"), tramo=F.col("t"), order=F.col("o"))
    return pres, rec


def test_first_values_of_rows_that_miss_some(spark):
    _, rec = registers(spark)
    exact = {(r.project_key, r.tramo_clean): r[3:6] for r in linkage.exact_rollup(rec).collect()}
    assert exact == {("1::c", "a"): ("Y", 20.0, "M2"), ("1::c", "b"): (None, None, None), ("2::c", "a"): (None, None, None),
                     ("3::c", "a"): ("W", 6.0, "M9"), ("7::c", "a"): ("U", 8.0, "M8"), ("7::c", "b"): ("T", 1.0, "M8")}
    keys = {r.project_key: r[2:5] for r in linkage.project_rollup(rec).collect()}
    assert keys == {"1::c": ("Y", 20.0, "M2"), "2::c": (None, None, None), "3::c": ("W", 6.0, "M9"), "7::c": ("U", 8.0, "M8")}


def test_rows_with_all_attributes_keep_their_order_once(spark):
    _, rec = registers(spark)
    tranches = linkage.tranche_rollup(rec)
    rows = {(r.project_key, r.tramo_clean): r for r in tranches.collect()}
    full = rows["7::c", "a"]
    assert sum(v is not None and hasattr(v, "o") for v in full) == 1  # three structs with the order before


def test_only_wanted_columns_are_numbered(spark, monkeypatch):
    pres, rec = registers(spark)
    seen = recorded(monkeypatch, rowid)
    auth = consolidate.authoritative(pres, rec, sort=False, columns=("rut", "regimen"))
    assert len(seen) == 1 and set(seen[0]) == {"_branch", "_order_p", "_order_r", "rut", "regimen", "_rid_part", "_rid_pos"}, seen
    rows = sorted((r.project_row_id, r.rut, r.regimen) for r in auth.collect())
    assert [r[0] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [r[1] for r in rows] == ["1", "2", "3", "4", None, None, "7", "7"]
    assert [r[2] for r in rows[5:]] == ["V", "U", "T"]


def test_recommended_only_carries_the_key_once(plain):
    pres, rec = registers(plain)
    only = linkage.recommended_only(pres, rec)
    assert only.columns[: len(rec.columns)] == rec.columns
    rows = sorted((r.rut or "", r.project_key or "", r.regimen) for r in only.collect())
    assert rows == [("", "", "V"), ("7", "7::c", "T"), ("7", "7::c", "U")]
    # the order is not part of the key of a row without one
    assert "xxhash64(_order" not in only.select("project_key", "monto_ui")._jdf.queryExecution().optimizedPlan().toString()


def test_unlinked_rows_are_exchanged_twice(plain, tmp_path):
    pres, rec = registers(plain)
    pres.write.parquet(f"{tmp_path}/p")
    rec.write.parquet(f"{tmp_path}/r")
    pres, rec = plain.read.parquet(f"{tmp_path}/p"), plain.read.parquet(f"{tmp_path}/r")
    got = linkage.unlinked_recommended(pres, rec)
    assert sorted((r.project_key, r.tramo_clean, r.monto_ui) for r in got.collect()) == [("1::c", "b", None), ("3::c", "a", 6.0), ("3::c", "a", 9.0)]
    assert plan_of(got).count("SortMergeJoin") == 2, plan_of(got)  # three before


def test_levels_are_not_exchanged(plain):
    auth = consolidate.authoritative(*registers(plain), with_ids=False, sort=False)
    out = deck.promoted_projects(auth)
    assert not re.search(r"hashpartitioning\(_level#\d+, [^)]*project_key", plan_of(out)), plan_of(out)
    total = next(r for r in out.collect() if r.is_total)
    assert (total.proyectos, total.proyectos_promovidos) == (5, 3)


def test_versions_are_not_exchanged_by_file(plain):
    t = datetime.datetime(2020, 1, 1)
    files = plain.createDataFrame([("d/f.xlsx", t, "1"), ("d/f v2.xlsx", t.replace(year=2021), "2")], "path string, modificationTime timestamp, content_hash string")
    rows = plain.createDataFrame([("d/f.xlsx", 1, "x"), ("d/f.xlsx", 2, "y"), ("d/f v2.xlsx", 2, "z"), ("d/f v2.xlsx", 3, None)], "path string, k int, v string")
    diff = versions.version_diff(rows, versions.version_chain(files), ["k"], ["v"])
    assert "hashpartitioning(_path" not in plan_of(diff), plan_of(diff)
    assert sorted((r.k, r.change) for r in diff.collect()) == [(1, "removed"), (2, "changed"), (3, "added")]


@pytest.mark.parametrize("name, widest", [
    ("sketched_projects", 5), ("published_audit", 8), ("metric_lineage", 12), ("combined_lineage", 8), ("drill_through", 12)])
def test_written_tables_hold_what_is_read(spark, monkeypatch, name, widest):
    seen = recorded(monkeypatch, rowid, queries_deck, queries_forms)
    df = catalog.QUERIES[name](ensure_conf(spark), SF)
    assert all(len(c) <= widest for c in seen) and len(seen) == (2 if name == "combined_lineage" else 1), seen
    assert "lineitem.parquet" not in plan_of(df)  # what is written is not computed again


def test_published_order_writes_the_table_once(spark, monkeypatch):
    seen = recorded(monkeypatch, queries_linkage)
    catalog.QUERIES["published_order"](ensure_conf(spark), SF)
    assert len(seen) == 1 and set(seen[0]) == {"published", "row_name", "place"}, seen


@pytest.mark.parametrize("wanted", [lambda a: reports.summary_by_group(a), lambda a: a.select("ministerio_evaluador", "monto_ui_presentado"), reports.linkage_audit])
def test_both_grains_read_one_rollup_whatever_is_wanted(plain, wanted):
    """Recommended rows are read twice: for the rollup that both grains share, and for those without a presented key."""
    pres, rec = registers(plain)
    plan = plan_of(wanted(consolidate.authoritative(pres, rec, with_ids=False, sort=False)))
    assert "ReusedExchange" in plan
    assert len(re.findall(r"Scan ExistingRDD\[k#\d+,t#\d+,o#\d+,reg#", plan)) == 2


def test_numbers_and_other_texts_keep_their_digits(spark):
    raw = ["12", "007", "-5", "+5", " 5", "12.5", "1e3", "9223372036854775807", "9223372036854775808", "12.345.678-9", "0", "-0", "", "-", "abc", "١", None]
    df = spark.createDataFrame([(x,) for x in raw], "x string")
    expected = [None if x is None else re.sub("[^0-9]", "", x) or None for x in raw]
    assert [r[0] for r in df.select(tx.normalize_rut("x")).collect()] == expected
