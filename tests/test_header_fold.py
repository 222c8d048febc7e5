"""Header inference reads the rows once, exchanges only the preview, and joins nothing but the files."""

from regfuse.operators import headers as H
from regfuse.plans import pipeline


def cells(*texts):
    return {i: ("text", t, None, None) for i, t in enumerate(texts, 1) if t is not None}


def frames(spark, sheets):
    rows = [("p.xlsx", sheet, i, r, cells(*texts), False) for i, (sheet, rs) in enumerate(sheets.items(), 1) for r, texts in rs.items()]
    return spark.createDataFrame(rows, H.ROWS_SCHEMA), spark.createDataFrame([("p.xlsx", "presentados", 1)], "source_path string, dataset string, file_rank int")


def test_plan_of_the_fold(spark, tmp_path):
    rows, files = frames(spark, {"A": {r: ("RUT", "Empresa") if r == 3 else ("1", "x") for r in range(1, 200)}})
    rows.write.parquet(f"{tmp_path}/rows")
    inf = pipeline.infer(spark.read.parquet(f"{tmp_path}/rows"), files)
    for df, exchanges in ((inf.sheets, 1), (inf.chosen, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1, plan
        assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan, plan  # the limit works before the exchange
        assert plan.count("Exchange ") <= exchanges, plan  # broadcasts included
        assert "NestedLoop" not in plan
    assert inf.chosen.first().header_row == 3


def test_preview_is_25_row_numbers_from_the_first_row(spark):
    late = {10: ("t",), **{r: ("1", "2") for r in range(11, 34)}, 34: ("RUT", "Empresa", "Código"), 35: ("RUT", "Empresa", "Código", "Tramo")}
    sheet = H.sheets(frames(spark, {"A": late})[0]).first()
    assert (sheet.first_row, sheet.header_row, sheet.header_score) == (10, 34, 3)
    sparse = {1: ("t",), 26: ("RUT", "Empresa", "Código")}
    assert H.sheets(frames(spark, {"A": sparse})[0]).first().header_row == 1


def test_ties_blanks_repeats_and_partial_hits(spark):
    rows, files = frames(spark, {
        "Uno": {1: ("Empresa", "Total"), 2: ("Empresa", None, "Monto")},
        "Dos": {2: (" ", "Fecha", "RUT", "Fecha", "Nro. Expediente", "Expediente viejo", "Equipo"), 3: ("x", "1", "2", "3", "4", "5", "6")},
    })
    inf = pipeline.infer(rows, files)
    chosen = inf.chosen.first()
    assert (chosen.source_sheet, chosen.header_row, chosen.header_score, chosen.sheet_score) == ("Dos", 2, 4, 4)
    assert chosen.mapping == {"fecha_presentado": 2, "rut": 3, "codigo": 5, "monto_ui": 7}
    names = {r.col_idx: r.name for r in H.header_names(inf.sheets).where("source_sheet = 'Dos'").collect()}
    assert names == {2: "fecha_2", 3: "rut", 4: "fecha_4", 5: "nro_expediente", 6: "expediente_viejo", 7: "equipo"}
    exact = {r.field: r.exact for r in H.resolved_columns(inf.sheets).where("source_sheet = 'Dos'").collect()}
    assert exact == {"fecha_presentado": False, "rut": True, "codigo": True, "monto_ui": False}


def test_empty_rows(spark):
    rows, files = frames(spark, {})
    assert pipeline.infer(rows, files).chosen.collect() == []
