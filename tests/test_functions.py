"""Scalar vectors for the normalisers (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from regfuse.functions import dates as D
from regfuse.functions import numbers as N
from regfuse.functions import text as tx


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r["y"] for r in df.select("i", fn("x").alias("y")).orderBy("i").collect()]


def test_normalize_name(spark):
    got = one_col(spark, ["Razón Social", "  Nº Expediente ", "__a--b__", "-", None, "Straße", "FECHA_Ñandú"],
                  tx.normalize_name)
    assert got == ["razon_social", "no_expediente", "a_b", "", None, "strasse", "fecha_nandu"]


def test_normalize_name_idempotent(spark):
    vals = ["Razón Social", "  Nº Expediente ", "x--Y", "ÁÉÍ óú"]
    once = one_col(spark, vals, tx.normalize_name)
    twice = one_col(spark, once, tx.normalize_name)
    assert once == twice


def test_as_text(spark):
    got = one_col(spark, ["a  b  c", "  x ", None, "\t\n"], tx.as_text)
    assert got == ["a b c", "x", None, ""]


def test_normalize_rut(spark):
    assert one_col(spark, ["21.000.000-0011", "s/d", "", None], tx.normalize_rut) == ["210000000011", None, None, None]
    assert one_col(spark, [2.1e11], lambda c: tx.normalize_rut(tx.num_to_text(c)), "double") == ["210000000000"]


def test_num_to_text(spark):
    assert one_col(spark, [2020.0, 2.1e11, 1863.84, -5.5], tx.num_to_text, "double") == [
        "2020", "210000000000", "1863.84", "-5.5"]


def test_normalize_codigo(spark):
    assert one_col(spark, [" 2020  1 ", "2020.0", "", "   ", None], tx.normalize_codigo) == [
        "2020 1", "2020", None, None, None]


def test_normalize_ministerio(spark):
    got = one_col(spark, ["M.E.F.", "MEF - Comisión", "Min. de Ganadería", "Ministerio de Turismo", "otro ñ", "", None],
                  tx.normalize_ministerio)
    assert got == ["M.E.F.", "MEF", "MGAP", "MINTUR", "OTRO Ñ", "", None]


def test_es_ampliacion(spark):
    got = one_col(spark, ["1a. Ampliación", "inicial", None], lambda c: tx.es_ampliacion(tx.tramo_clean(c)))
    assert got == [True, False, False]


def test_composite_key(spark):
    df = spark.createDataFrame([("21", "a"), (None, "a"), ("21", None)], "a string, b string")
    got = [r[0] for r in df.select(tx.composite_key("a", "b")).collect()]
    assert got == ["21::a", None, None]


NUMBER_VECTORS = [
    ("U$S 1.234.567,89", 1234567.89, 1.234),
    ("1,234,567.89", 1.234, 1234567.89),
    ("1234567.89", 123456789.0, 1234567.89),
    ("UI 500", 500.0, 500.0),
    ("-", None, None),
    ("", None, None),
    ("-12,5", -12.5, -125.0),
    ("Cant. 500", 500.0, None),
    ("Monto, 500", None, 500.0),
    ("abc", None, None),
    ("1.000", 1000.0, 1.0),
    ("12 UI aprox", 12.0, 12.0),
    ("7%", 7.0, 7.0),
]


def test_parse_number_locales(spark):
    texts = [t for t, _, _ in NUMBER_VECTORS]
    comma = one_col(spark, texts, lambda c: N.parse_number(c, "comma"))
    dot = one_col(spark, texts, lambda c: N.parse_number(c, "dot"))
    assert comma == [c for _, c, _ in NUMBER_VECTORS]
    assert dot == [d for _, _, d in NUMBER_VECTORS]


def test_locale_vote_ties_go_to_comma(spark):
    df = spark.createDataFrame(
        [("f1", "1,234,567.89"), ("f1", "2,000.50"), ("f2", "1.234,5"), ("f2", "x"), ("f3", "Monto, 500")],
        "f string, t string")
    v = {r["f"]: r["locale"] for r in N.locale_vote(df, ["f"], "t").collect()}
    assert v == {"f1": "comma", "f2": "comma", "f3": "dot"}


DATE_VECTORS = [
    ("31/12/2020", dt.date(2020, 12, 31)),
    ("2020-1-2", dt.date(2020, 1, 2)),
    ("01/02/2020", dt.date(2020, 2, 1)),
    ("12/31/2020", dt.date(2020, 12, 31)),
    ("31.12.85", dt.date(1985, 12, 31)),
    ("29/2/96", dt.date(1996, 2, 29)),
    ("29/2/00", dt.date(2000, 2, 29)),
    ("1/2/68", dt.date(2068, 2, 1)),
    ("44000", dt.date(2020, 6, 18)),
    ("02/30/2020", None),
    ("29/2/2019", None),
    ("31122020", dt.date(2020, 12, 31)),
    ("20201231", dt.date(2020, 12, 31)),
    ("2020-01-02 00:00:00", dt.date(2020, 1, 2)),
    ("", None),
    (None, None),
    ("sin fecha", None),
]


def test_parse_date_text_staged(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATE_VECTORS)], "i int, t string")
    got = [r["d"] for r in D.with_parsed_date(df, "t", "d").orderBy("i").collect()]
    assert got == [d for _, d in DATE_VECTORS]


def test_parse_date_text_column(spark):
    got = one_col(spark, [t for t, _ in DATE_VECTORS], D.parse_date_text)
    assert got == [d for _, d in DATE_VECTORS]


def test_cell_date_dispatch(spark):
    df = spark.createDataFrame(
        [("date", None, None, dt.datetime(2021, 3, 4, 15, 0)), ("number", None, 44000.75, None),
         ("text", "4/3/2021", None, None), ("bool", "TRUE", None, None)],
        "t string, s string, n double, ts timestamp_ntz")
    got = [r[0] for r in df.select(D.cell_date("t", "s", "n", "ts")).collect()]
    assert got == [dt.date(2021, 3, 4), dt.date(2020, 6, 18), dt.date(2021, 3, 4), None]


def test_serial_floor(spark):
    assert one_col(spark, [44000.99], D.serial_to_date, "double") == [dt.date(2020, 6, 18)]


def test_blank_row_filter_keeps_key_rows(spark):
    from regfuse.operators.register import standardize

    df = spark.createDataFrame([(1, None, "D143", "inicial"), (2, "21", None, None), (3, " .0 ", None, None)],
                               "i int, codigo string, regimen string, tramo string")
    out = standardize(df, codigo=F.col("codigo"), regimen=F.col("regimen"), tramo=F.col("tramo"),
                      extra={"i": F.col("i")})
    assert sorted(r["i"] for r in out.collect()) == [2]
