"""Golden linkage (FIXTURES.md section 4): every match method, Q2-Q8."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regfuse.operators import consolidate, linkage, reports
from regfuse.operators.register import standardize

D = dt.date

PRES = [
    (1, "210000000011", "2020-1", "A", "MEF", D(2020, 1, 10), None, "inicial", 1000.0),
    (2, "210000000011", "2020-1", "A", "MEF", D(2020, 3, 1), None, "ampliacion", 200.0),
    (3, "210000000022", "2020-2", "B", None, D(2020, 2, 1), None, "inicial", 500.0),
    (4, "210000000033", "2020-3", "C", "MIEM", D(2020, 2, 5), None, None, 700.0),
    (5, "210000000044", "2020-4", "D", None, D(2020, 4, 1), None, "inicial", 300.0),
    (6, None, "2020-5", "E", "MINTUR", D(2020, 5, 1), None, "inicial", 50.0),
    (7, "210000000066", "2020-6", "F", "MEF", D(2020, 6, 1), None, "inicial", 60.0),
    (8, "210000000077", "2020-7", "G", "MIEM", D(2020, 7, 1), None, "inicial", 70.0),
    (9, "210000000088", "2020-8", "H", "MIEM", D(2020, 8, 1), "D455", "inicial", 80.0),
]
REC = [
    (1, "210000000011", "2020-1", "A", "MEF", D(2020, 6, 30), "D143", "inicial", 900.0),
    (2, "210000000011", "2020-1", "A", "MEF", D(2020, 5, 15), None, "inicial", 950.0),
    (3, "210000000011", "2020-1", "A", "MEF", D(2020, 9, 1), "D143", "ampliacion", None),
    (4, "210000000022", "2020-2", "B", "MIEM", D(2020, 7, 1), "D143", "otro", 450.0),
    (5, "210000000033", "2020-3", "C", "MIEM", D(2020, 8, 1), "D143", "inicial", 650.0),
    (6, "210000000033", "2020-3", "C", "MIEM", D(2020, 8, 2), "D143", "ampliacion", 60.0),
    (7, None, "2020-5", "E", "MINTUR", D(2020, 10, 1), "D143", "inicial", 45.0),
    (8, "210000000066", "2020-6", "F", "MEF", None, "D268", "inicial", 55.0),
    (9, "210000000066", "2020-6", "F", "MEF", None, "D268", "inicial", 56.0),
    (10, "210000000077", "2020-7", "G", "MIEM", D(2020, 12, 1), "D268", "otro", 65.0),
    (11, "210000000077", "2020-7", "G", "MIEM", None, "D268", "inicial", 66.0),
    (12, "210000000088", "2020-8", "H", "MIEM", None, "D268", "inicial", 81.0),
    (13, "210000000099", "2020-9", "I", "MGAP", None, "D268", None, 90.0),
]
SCHEMA = "id int, rut string, codigo string, emp string, min string, fecha date, regimen string, tramo string, monto double"


def _reg(spark, rows, date_field):
    df = spark.createDataFrame(rows, SCHEMA)
    kw = {date_field: F.col("fecha")}
    return standardize(
        df, rut=F.col("rut"), codigo=F.col("codigo"), empresa=F.col("emp"), ministerio_evaluador=F.col("min"),
        regimen=F.col("regimen"), tramo=F.col("tramo"), monto_ui=F.col("monto"),
        source_file=F.lit("golden.xlsx"), source_row=F.col("id") + 1, order=F.col("id"), **kw)


@pytest.fixture(scope="module")
def regs(spark):
    return _reg(spark, PRES, "fecha_presentado"), _reg(spark, REC, "fecha_recomendado")


EXPECTED = [
    # id, method, codigo, ministerio, fecha_rec, regimen, presentado, recomendado, ben, has, n
    (1, "rut_codigo_tramo", "2020-1", "MEF", D(2020, 5, 15), "D143", 1000.0, 900.0, 900.0, True, 2),
    (2, "rut_codigo_tramo", "2020-1", "MEF", D(2020, 9, 1), "D143", 200.0, None, 200.0, True, 1),
    (3, "rut_codigo_unique", "2020-2", "MIEM", D(2020, 7, 1), "D143", 500.0, 450.0, 450.0, True, 1),
    (4, "rut_codigo_ambiguous", "2020-3", "MIEM", None, None, 700.0, None, None, False, 2),
    (5, "presentado_only", "2020-4", None, None, None, 300.0, None, None, False, None),
    (6, "presentado_only", "2020-5", "MINTUR", None, None, 50.0, None, None, False, None),
    (7, "rut_codigo_ambiguous", "2020-6", "MEF", None, "D268", 60.0, 55.0, None, False, 2),
    (8, "rut_codigo_ambiguous", "2020-7", "MIEM", None, "D268", 70.0, 66.0, None, False, 1),
    (9, "rut_codigo_unique", "2020-8", "MIEM", None, "D268", 80.0, 81.0, None, False, 1),
    (10, "recomendado_only", "2020-5", "MINTUR", D(2020, 10, 1), "D143", 45.0, 45.0, 45.0, True, 1),
    (11, "recomendado_only", "2020-9", "MGAP", None, "D268", 90.0, 90.0, None, False, 1),
]


def test_authoritative_rows(regs):
    p, r = regs
    auth = consolidate.authoritative(p, r)
    rows = auth.collect()
    got = sorted(
        (x.project_row_id, x.match_method, x.codigo, x.ministerio_evaluador, x.fecha_recomendado, x.regimen,
         x.monto_ui_presentado, x.monto_ui_recomendado, x.monto_ui_beneficios, x.has_benefits,
         x.recommended_rows_for_key)
        for x in rows
    )
    assert got == EXPECTED
    # published order: rut, codigo, date, tramo with NULLs last -> rows without rut at the end
    assert [x.project_row_id for x in rows][-2:] == [6, 10]
    assert {x.project_row_id: x.source for x in rows}[10] == "recomendado_only"


def test_audit(regs):
    auth = consolidate.authoritative(*regs, with_ids=False, sort=False)
    got = {(r.match_method, r.source): r.rows for r in reports.linkage_audit(auth).collect()}
    assert got == {
        ("presentado_only", "presentado"): 2, ("recomendado_only", "recomendado_only"): 2,
        ("rut_codigo_ambiguous", "presentado"): 3, ("rut_codigo_tramo", "presentado"): 2,
        ("rut_codigo_unique", "presentado"): 2,
    }


def test_summary(regs):
    auth = consolidate.authoritative(*regs, with_ids=False, sort=False)
    got = [tuple(r) for r in reports.summary_by_group(auth).collect()]
    assert got == [
        ("MEF", 3, 2, 1, 1, 2, 1100.0, 1260.0),
        ("MIEM", 4, 4, 0, 1, 1, 450.0, 1350.0),
        ("MINTUR", 2, 0, 0, 0, 1, 45.0, 95.0),
        ("MGAP", 1, 1, 0, 0, 0, 0.0, 90.0),
        ("SIN_DATO", 1, 1, 0, 0, 0, 0.0, 300.0),
    ]


def test_unlinked_recommended(regs):
    got = sorted(r.monto_ui for r in linkage.unlinked_recommended(*regs).collect())
    assert got == [60.0, 65.0, 650.0]   # recomendados 6, 10 and 5 feed no output row


def test_invariants(regs):
    p, r = regs
    auth = consolidate.authoritative(p, r)
    n = auth.count()
    assert n == p.count() + linkage.recommended_only(p, r).count()
    assert linkage.link_presented(p, r).count() == p.count()
    assert auth.where(F.col("has_benefits") != F.col("fecha_recomendado").isNotNull()).count() == 0
    ids = sorted(x.project_row_id for x in auth.select("project_row_id").collect())
    assert ids == list(range(1, n + 1))


def test_partitioning_does_not_change_result(regs):
    p, r = regs
    a1 = consolidate.authoritative(p, r).collect()
    a2 = consolidate.authoritative(p.repartition(5), r.repartition(3, "tramo")).collect()
    assert a1 == a2
