"""Workbooks on disk -> the whole batch job (discover, decode, infer, link, write)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from regfuse.operators import headers as H
from regfuse.plans import pipeline
from regfuse.sources import workbook as W
from tests.test_linkage_golden import PRES, REC
from tests.xlsx_writer import write_xlsx

D = dt.date


def _pres_row(t, as_number_rut=False):
    _, rut, cod, emp, mn, fecha, reg, tramo, monto = t
    rut_v = float(rut) if (as_number_rut and rut) else rut
    return [rut_v, cod, emp, mn, fecha, reg, tramo, monto]


def _rec_date(i, d):
    if d is None:
        return None
    if i % 3 == 0:
        return d                                         # date cell
    if i % 3 == 1:
        return (dt.datetime(d.year, d.month, d.day) - dt.datetime(1899, 12, 30)).days  # serial number
    return d.strftime("%d/%m/%Y")                        # text


@pytest.fixture(scope="module")
def folder():
    root = tempfile.mkdtemp(prefix="regfuse-wb-")
    os.makedirs(os.path.join(root, "sub"))
    hdr = ["RUT", "Código", "Razón Social", "Ministerio", "Fecha de Presentación", "Régimen", "Tramo", "Monto UI"]
    write_xlsx(os.path.join(root, "Presentados 2020.xlsx"),
               {"Hoja1": {1: hdr, **{i + 2: _pres_row(t, as_number_rut=True) for i, t in enumerate(PRES[:5])}}})
    write_xlsx(os.path.join(root, "sub", "Registro PRESENTADOS.xlsm"), {
        "Notas": {1: ["Empresa", "Comentario"], 2: ["x", "y"]},
        "Datos": {1: ["Registro de proyectos"], 2: ["Proyectos presentados"], 3: ["corte 2020"],
                  6: ["Nro RUT", "Expediente", "Empresa", "Organismo", "Fecha", "Decreto", "Etapa", "Inversión UI"],
                  **{7 + i: _pres_row(t) for i, t in enumerate(PRES[5:])}},
    })
    rec_hdr = ["R.U.T.", "Código", "Razón Social", "Ministerio", "Fecha Resolución", "Régimen", "Tramo", "",
               "Monto UI", "Fecha"]
    rec_rows = {}
    for i, (_, rut, cod, emp, mn, fecha, reg, tramo, monto) in enumerate(REC):
        monto_txt = None if monto is None else f"{monto:.2f}".replace(".", ",")
        rec_rows[i + 3] = [rut, cod, emp, mn, _rec_date(i, fecha), reg, tramo, "nota", monto_txt, "s/f"]
    write_xlsx(os.path.join(root, "Recomendados.xlsx"), {"Recomendados": {1: ["Listado"], 2: rec_hdr, **rec_rows}})
    write_xlsx(os.path.join(root, "otros.xlsx"), {"A": {1: ["nada"]}})
    write_xlsx(os.path.join(root, "~$Recomendados.xlsx"), {"A": {1: ["lock"]}})
    with open(os.path.join(root, "roto_recomendados.xlsx"), "wb") as f:
        f.write(b"not a zip file at all")
    with open(os.path.join(root, "viejo_presentados.xls"), "wb") as f:
        f.write(b"\xd0\xcf\x11\xe0legacy")
    return root


def test_inventory(spark, folder):
    inv = W.inventory(spark, folder, os.path.join(folder, "processed"))
    st = {r.file_name: (r.status, sorted(r.datasets)) for r in inv.collect()}
    assert st["Presentados 2020.xlsx"] == ("selected", ["presentados"])
    assert st["Registro PRESENTADOS.xlsm"] == ("selected", ["presentados"])
    assert st["Recomendados.xlsx"] == ("selected", ["recomendados"])
    assert st["otros.xlsx"][0] == "unclassified"
    assert st["~$Recomendados.xlsx"][0] == "lock_file"
    assert st["viejo_presentados.xls"][0] == "unsupported_format"
    assert st["roto_recomendados.xlsx"][0] == "selected"


def test_decode_and_headers(spark, folder):
    decoded = W.read_decoded(spark, folder)
    errors = {os.path.basename(r.source_path) for r in W.decode_errors(decoded).collect()}
    assert errors == {"roto_recomendados.xlsx"}
    rows = W.read_rows(decoded)
    files = W.selected_files(W.inventory(spark, folder))
    inf = pipeline.infer(rows, files)
    chosen = {(os.path.basename(r.source_path), r.dataset): (r.source_sheet, r.header_row)
              for r in inf.chosen.collect()}
    assert chosen[("Registro PRESENTADOS.xlsm", "presentados")] == ("Datos", 6)
    assert chosen[("Presentados 2020.xlsx", "presentados")] == ("Hoja1", 1)
    assert chosen[("Recomendados.xlsx", "recomendados")] == ("Recomendados", 2)
    res = {(os.path.basename(r.source_path), r.field): (r.col_idx, r.column_name)
           for r in H.resolved_columns(inf.sheets).collect()}
    # duplicate-free 'Fecha' column: partial match of fecha_presentado goes to the first column containing it
    assert res[("Recomendados.xlsx", "fecha_recomendado")] == (5, "fecha_resolucion")
    assert res[("Recomendados.xlsx", "codigo")] == (2, "codigo")
    assert res[("Recomendados.xlsx", "empresa")] == (3, "razon_social")


def test_full_run(spark, folder):
    out_dir = os.path.join(folder, "processed")
    outs = pipeline.run(spark, folder, out_dir)
    audit = {(r.match_method, r.source): r.rows for r in outs["linkage_audit"].collect()}
    assert audit == {
        ("presentado_only", "presentado"): 2, ("recomendado_only", "recomendado_only"): 2,
        ("rut_codigo_ambiguous", "presentado"): 3, ("rut_codigo_tramo", "presentado"): 2,
        ("rut_codigo_unique", "presentado"): 2,
    }
    auth = {r.project_row_id: r for r in outs["projects_authoritative"].collect()}
    assert auth[1].fecha_recomendado == D(2020, 5, 15) and auth[1].monto_ui_recomendado == 900.0
    assert auth[3].ministerio_evaluador == "MIEM" and auth[3].match_method == "rut_codigo_unique"
    assert auth[6].source_file == "Registro PRESENTADOS.xlsm" and auth[6].source_row == 7
    summary = [tuple(r) for r in outs["summary_by_ministerio"].collect()]
    assert summary[0] == ("MEF", 3, 2, 1, 1, 2, 1100.0, 1260.0)
    for name in ("presentados_normalized", "recomendados_normalized",
                 "projects_authoritative", "summary_by_ministerio", "linkage_audit"):
        assert os.path.isdir(os.path.join(out_dir, name))
    csv = spark.read.option("header", True).csv(os.path.join(out_dir, "linkage_audit"))
    assert csv.agg(F.sum(F.col("rows").cast("int"))).first()[0] == 11
    ids = spark.read.option("header", True).csv(os.path.join(out_dir, "presentados_normalized"))
    assert sorted(int(r.presentado_row_id) for r in ids.collect()) == list(range(1, 10))
    ledger = {r.file_name: r for r in outs["ledger"].collect()}
    assert ledger["roto_recomendados.xlsx"].decode_error is not None
    assert ledger["otros.xlsx"].status == "unclassified"


def test_missing_dataset_fails(spark):
    root = tempfile.mkdtemp(prefix="regfuse-wb-empty-")
    write_xlsx(os.path.join(root, "presentados.xlsx"), {"A": {1: ["RUT", "Codigo"], 2: ["1", "2"]}})
    with pytest.raises(FileNotFoundError):
        pipeline.run(spark, root)
