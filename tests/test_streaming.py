"""Incremental ingestion: each workbook is decoded once, as it lands."""

import os
import tempfile
import time

import pytest

from regfuse.operators import reports
from regfuse.sources import sinks
from regfuse.streaming.ingest import link_decoded, refresh, refreshed_rows, start_ingest, start_refresh
from tests.test_linkage_golden import PRES, REC
from tests.xlsx_writer import write_xlsx

HDR = ["RUT", "Código", "Razón Social", "Ministerio", "Fecha", "Régimen", "Tramo", "Monto UI"]


def _sheet(rows, date_hdr):
    hdr = HDR[:4] + [date_hdr] + HDR[5:]
    return {"Hoja1": {1: hdr, **{i + 2: list(t[1:]) for i, t in enumerate(rows)}}}


def test_available_now_ingest_then_link(spark):
    inp = tempfile.mkdtemp(prefix="regfuse-in-")
    table = tempfile.mkdtemp(prefix="regfuse-tbl-")
    ckpt = tempfile.mkdtemp(prefix="regfuse-sck-")
    write_xlsx(os.path.join(inp, "a_presentados.xlsx"), _sheet(PRES[:5], "Fecha Presentación"))
    write_xlsx(os.path.join(inp, "recomendados.xlsx"), _sheet(REC, "Fecha Resolución"))
    q = start_ingest(spark, inp, table, ckpt, available_now=True)
    q.awaitTermination(300)
    first = spark.read.parquet(table).count()
    assert first == 5 + 13 + 2   # data rows plus one header row per workbook

    write_xlsx(os.path.join(inp, "b_presentados.xlsx"), _sheet(PRES[5:], "Fecha Presentación"))
    q = start_ingest(spark, inp, table, ckpt, available_now=True)
    q.awaitTermination(300)
    assert spark.read.parquet(table).count() == first + 4 + 1   # only the new workbook was decoded

    regs, auth = link_decoded(spark, table, inp)
    assert regs["presentados"].count() == 9
    audit = {(r.match_method, r.source): r.rows for r in reports.linkage_audit(auth).collect()}
    assert audit[("rut_codigo_tramo", "presentado")] == 2
    assert audit[("recomendado_only", "recomendado_only")] == 2
    assert sum(audit.values()) == 11


def _cells(spark, table):
    """file -> texts of the first column's data rows."""
    rows = refreshed_rows(spark, table).where("row_idx > 0").select("source_path", "row_idx", "cells").collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.source_path, r.row_idx)):
        first = r.cells[min(r.cells)]
        out.setdefault(os.path.basename(r.source_path), []).append(first.text)
    return out


def _book(folder, name, values):
    write_xlsx(os.path.join(folder, name), {"Hoja1": {i + 1: [v, "x"] for i, v in enumerate(["RUT", *values])}})


def test_rewritten_workbook_replaces_its_rows(spark, monkeypatch):
    inp, table = tempfile.mkdtemp(prefix="regfuse-in-"), tempfile.mkdtemp(prefix="regfuse-tbl-")
    assert refresh(spark, inp, table) == {} and refreshed_rows(spark, table).count() == 0
    _book(inp, "a_presentados.xlsx", ["one", "two"])
    _book(inp, "b_presentados.xlsx", ["three"])
    _book(inp, "recomendados.xlsx", ["four"])
    assert refresh(spark, inp, table) == {"new": 3}
    first = _cells(spark, table)
    assert {k: v[1:] if v[0] == "RUT" else v for k, v in first.items()} == {
        "a_presentados.xlsx": ["one", "two"], "b_presentados.xlsx": ["three"], "recomendados.xlsx": ["four"]}
    assert refresh(spark, inp, table) == {}  # nothing to do

    _book(inp, "a_presentados.xlsx", ["one", "changed", "added"])
    os.utime(os.path.join(inp, "b_presentados.xlsx"), (time.time() + 50, time.time() + 50))
    os.rename(os.path.join(inp, "recomendados.xlsx"), os.path.join(inp, "recomendados 2.xlsx"))

    # a run that ends before the state is published changes nothing for readers
    with monkeypatch.context() as m:
        m.setattr(sinks, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh(spark, inp, table)
    assert _cells(spark, table) == first

    assert refresh(spark, inp, table) == {"replaced": 1, "touched": 1, "new": 1, "removed": 1}
    second = _cells(spark, table)
    assert second["a_presentados.xlsx"][-3:] == ["one", "changed", "added"] and "two" not in second["a_presentados.xlsx"]
    assert second["b_presentados.xlsx"] == first["b_presentados.xlsx"]
    assert "recomendados.xlsx" not in second and second["recomendados 2.xlsx"] == first["recomendados.xlsx"]


def test_refresh_at_every_trigger(spark):
    inp, table, ckpt = (tempfile.mkdtemp(prefix="regfuse-") for _ in range(3))
    _book(inp, "a_presentados.xlsx", ["one"])
    q = start_refresh(spark, inp, table, ckpt, processing_time="1 second")
    try:
        for values in (["one"], ["later", "rows"]):
            _book(inp, "a_presentados.xlsx", values)
            end = time.time() + 120
            while time.time() < end and _cells(spark, table).get("a_presentados.xlsx", [])[-len(values):] != values:
                assert q.exception() is None
                time.sleep(1)
            assert _cells(spark, table)["a_presentados.xlsx"][-len(values):] == values
    finally:
        q.stop()
