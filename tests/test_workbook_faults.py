"""Damaged and unusual workbooks: the run finishes, bad files add no rows and show in the ledger."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from regfuse.plans import pipeline
from tests.xlsx_writer import Raw, write_xlsx

HEADER = ["RUT", "Codigo", "Empresa", "Ministerio", "Fecha Presentado", "Tramo", "Monto UI"]
REC_HEADER = ["RUT", "Codigo", "Empresa", "Ministerio", "Fecha Recomendado", "Tramo", "Monto UI"]


def row(i, **changes):
    cells = {"rut": str(21000 + i), "codigo": f"2020-{i}", "empresa": f"E{i}", "min": "MEF", "fecha": dt.date(2020, 1, 1 + i), "tramo": "inicial", "monto": 10.0 * i}
    return list((cells | changes).values())


@pytest.fixture(scope="module")
def published(spark):
    root = tempfile.mkdtemp(prefix="regfuse-faults-")
    for d in "ab":
        os.makedirs(f"{root}/{d}")
    write_xlsx(f"{root}/a/presentados.xlsx", {"H": {1: HEADER, 2: row(1), 3: row(2, fecha="5 de marzo de 2020")}})
    write_xlsx(f"{root}/b/presentados.xlsx", {"H": {1: HEADER, 2: row(3, empresa=Raw("e", "#N/A"), min=Raw("e", "#REF!"), fecha="010220"),
                                                    3: [Raw("e", "#N/A")] * 7}})
    write_xlsx(f"{root}/recomendados.xlsx", {"H": {1: REC_HEADER, 2: row(1, empresa='say "hi", all'), 3: row(9), 4: row(1, tramo="otro")}})
    write_xlsx(f"{root}/recomendados 1904.xlsx", {"H": {1: REC_HEADER, 2: row(2, fecha=41_000, monto=0.1234567890123)}}, date1904=True)
    good = {"A": {1: HEADER, 2: row(5)}}
    write_xlsx(f"{root}/presentados cortado.xlsx", good | {"B": {1: HEADER, 2: row(6), 3: row(7)}}, cut=0.6)
    write_xlsx(f"{root}/presentados indice.xlsx", good | {"B": {1: HEADER, 2: [Raw("s", "99"), "x"]}})
    write_xlsx(f"{root}/presentados crc.xlsx", good | {"B": {1: HEADER, 2: row(6)}})
    with open(f"{root}/presentados crc.xlsx", "r+b") as f:
        data = f.read()
        at = data.index(b"xl/worksheets/sheet2.xml") + 60
        f.seek(at)
        f.write(bytes(b ^ 0x55 for b in data[at : at + 40]))
    before = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/regfuse-*"))
    outs = pipeline.run(spark, root, f"{root}/processed", aliases={
        "rut": ["rut"], "codigo": ["codigo"], "empresa": ["empresa"], "ministerio_evaluador": ["ministerio"], "fecha_presentado": ["fecha_presentado"],
        "fecha_recomendado": ["fecha_recomendado"], "regimen": ["regimen"], "tramo": ["tramo"], "monto_ui": ["monto_ui"]})
    after = set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/regfuse-*"))
    return root, outs, after - before


def test_bad_files_are_in_the_ledger_only(published):
    root, outs, _ = published
    ledger = {r.source_path.split(root)[1]: r for r in outs["ledger"].collect()}
    bad = {"/presentados cortado.xlsx", "/presentados indice.xlsx", "/presentados crc.xlsx"}
    assert {p for p, r in ledger.items() if r.decode_error} == bad
    files = {r.source_file for r in outs["projects_authoritative"].collect()}
    assert files == {"presentados.xlsx", "recomendados.xlsx"}
    assert all(ledger[p].presentados is None for p in bad)


def test_ledger_tells_equal_names_apart(published):
    root, outs, _ = published
    ledger = {r.source_path.split(root)[1]: r for r in outs["ledger"].collect()}
    a, b = ledger["/a/presentados.xlsx"], ledger["/b/presentados.xlsx"]
    assert (a.filas_con_clave, b.filas_con_clave, a.presentados, b.presentados) == (2, 1, 2, 1)
    assert a.rut_codigo_tramo + b.rut_codigo_tramo == 2 and b.presentado_only == 1


def test_error_cells_dates_and_epochs(published):
    _, outs, _ = published
    auth = {r.codigo: r for r in outs["projects_authoritative"].collect()}
    assert auth["2020-3"].empresa is None and auth["2020-3"].ministerio_evaluador is None
    assert auth["2020-3"].fecha_presentado == dt.date(2020, 2, 1)
    assert auth["2020-2"].fecha_presentado == dt.date(2020, 3, 5)
    assert auth["2020-2"].fecha_recomendado == dt.date(1904, 1, 1) + dt.timedelta(days=41_000)
    assert auth["2020-2"].monto_ui_recomendado == 0.1234567890123
    assert outs["projects_authoritative"].count() == 4


def test_published_csv(published, spark):
    root, outs, left = published
    assert left == set()  # intermediate tables are removed
    lines = "".join(open(f).read() for f in glob.glob(f"{root}/processed/recomendados_normalized/*.csv"))
    assert '"say ""hi"", all"' in lines
    assert [r.codigo for r in outs["unlinked_recommended"].collect()] == ["2020-1"]
    ids = [r.presentado_row_id for r in outs["presentados_normalized"].collect()]
    assert ids == sorted(ids) == [1, 2, 3]
    rows = outs["projects_authoritative"].select("rut", "codigo").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)
    audit = outs["linkage_audit"].agg(F.sum("rows")).first()[0]
    assert audit == 4


def test_plain_numbers(spark):
    from regfuse.functions.text import num_to_text

    values = {1e-12: "0.000000000001", 0.1234567890123: "0.1234567890123", 1e39: "1" + "0" * 39, 2.1e11: "210000000000", -1.5e-5: "-0.000015", 12345678.9: "12345678.9", 0.0: "0"}
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", num_to_text("x").alias("t"))
    assert {r.x: r.t for r in df.collect()} == values
