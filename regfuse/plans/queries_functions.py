"""Scalar normalisers on the driver's tables (whole tables, whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from regfuse.functions import dates as D
from regfuse.functions import numbers as N
from regfuse.functions import text as tx
from regfuse.functions.constants import MONTH_NAMES
from regfuse.operators.joins import join_small
from regfuse.operators.register import standardize
from regfuse.plans import oracle as O
from regfuse.plans.registry import register
from regfuse.plans.standins import table


# ---- F1 -------------------------------------------------------------------
@register("normalize_name_docs", f"""
SELECT doc_id, {O.norm_name('text')} AS name_norm FROM documents""")
def q_normalize_name_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", tx.normalize_name("text").alias("name_norm"))


# ---- F2 -------------------------------------------------------------------
@register("as_text_docs", f"""
SELECT doc_id, {O.as_text('text')} AS text_squished FROM documents""")
def q_as_text_docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", tx.as_text("text").alias("text_squished"))


# ---- F7 -------------------------------------------------------------------
@register("rule_classify", f"""
SELECT doc_id, nullif({O.norm_ministerio('text')}, '') AS ministerio_evaluador FROM documents""")
def q_rule_classify(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", tx.blank_to_null(tx.normalize_ministerio("text")).alias("ministerio_evaluador"))


# ---- F9 F10 ---------------------------------------------------------------
@register("tranche_flags", f"""
SELECT doc_id, length({O.tramo_clean('text')}) AS tramo_len,
       contains({O.tramo_clean('text')}, 'ampl') AS es_ampliacion
FROM documents""")
def q_tranche_flags(spark, sf_dir):
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    t = d.select("doc_id", tx.tramo_clean("text").alias("tc"))
    return t.select("doc_id", F.length("tc").alias("tramo_len"), tx.es_ampliacion("tc").alias("es_ampliacion"))


# ---- F5 -------------------------------------------------------------------
@register("digits_only_ids", f"""
SELECT c_custkey, {O.norm_rut('c_name')} AS rut_from_name,
       {O.num_to_text('c_acctbal')} AS balance_text,
       {O.norm_rut(O.num_to_text('c_acctbal'))} AS rut_from_balance
FROM customer""")
def q_digits_only_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    bal = tx.num_to_text("c_acctbal")
    return c.select(
        "c_custkey",
        tx.normalize_rut("c_name").alias("rut_from_name"),
        bal.alias("balance_text"),
        tx.normalize_rut(bal).alias("rut_from_balance"),
    )


# ---- F6 -------------------------------------------------------------------
def _decorated_code_sql() -> str:
    return ("('  ' || o_orderpriority || '   ' || CAST(o_orderkey AS VARCHAR) "
            "|| CASE WHEN o_orderstatus = 'F' THEN '.0' ELSE '' END || ' ')")


@register("code_cleanup", f"""
SELECT o_orderkey, {O.norm_codigo(_decorated_code_sql())} AS codigo FROM orders""")
def q_code_cleanup(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    decorated = F.concat(
        F.lit("  "), "o_orderpriority", F.lit("   "), F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") == "F", F.lit(".0")).otherwise(F.lit("")), F.lit(" "),
    )
    return o.select("o_orderkey", tx.normalize_codigo(decorated).alias("codigo"))


# ---- F11 ------------------------------------------------------------------
@register("composite_key", f"""
SELECT o_orderkey,
       {O.norm_rut("CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END")}
       || '::' || {O.norm_codigo('CAST(o_orderkey AS VARCHAR)')} AS project_key
FROM orders""")
def q_composite_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    rut = tx.normalize_rut(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")))
    cod = tx.normalize_codigo(F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", tx.composite_key(rut, cod).alias("project_key"))


# ---- F3 F3a A12 -----------------------------------------------------------
# Each order priority plays one workbook whose amount column is written in
# one text style; the locale vote runs per workbook.
def _amount_text_spark():
    p = F.col("o_orderpriority")
    x = F.col("o_totalprice")
    grouped_dot = F.format_number(x, 2)                                  # 1,234,567.89
    grouped_comma = F.translate(grouped_dot, ",.", ".,")                  # 1.234.567,89
    plain = F.format_string("%.2f", x)                                   # 1234567.89
    return (
        F.when(p == "1-URGENT", F.concat(F.lit("U$S "), grouped_comma))
        .when(p == "2-HIGH", grouped_dot)
        .when(p == "3-MEDIUM", plain)
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("UI "), F.replace(plain, F.lit("."), F.lit(","))))
        .otherwise(F.concat(plain, F.lit(" UI aprox")))
    )


def _amount_text_sql() -> str:
    plain = "printf('%.2f', o_totalprice)"
    gdot = "format('{:,.2f}', o_totalprice)"
    return f"""(CASE o_orderpriority
        WHEN '1-URGENT' THEN 'U$S ' || translate({gdot}, ',.', '.,')
        WHEN '2-HIGH' THEN {gdot}
        WHEN '3-MEDIUM' THEN {plain}
        WHEN '4-NOT SPECIFIED' THEN 'UI ' || replace({plain}, '.', ',')
        ELSE {plain} || ' UI aprox' END)"""


@register("amount_locale_vote", f"""
WITH t AS (SELECT o_orderkey, o_orderpriority AS source_file, {_amount_text_sql()} AS amount_text FROM orders),
v AS (SELECT source_file,
             count({O.parse_number('amount_text', 'comma')}) AS n_comma,
             count({O.parse_number('amount_text', 'dot')}) AS n_dot
      FROM t GROUP BY source_file)
SELECT t.o_orderkey, t.source_file, t.amount_text,
       CASE WHEN v.n_dot > v.n_comma THEN 'dot' ELSE 'comma' END AS locale,
       CASE WHEN v.n_dot > v.n_comma THEN {O.parse_number('t.amount_text', 'dot')}
            ELSE {O.parse_number('t.amount_text', 'comma')} END AS monto_ui
FROM t JOIN v USING (source_file)""")
def q_amount_locale_vote(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    t = o.select("o_orderkey", F.col("o_orderpriority").alias("source_file"), _amount_text_spark().alias("amount_text"))
    vote = N.locale_vote(t, ["source_file"], "amount_text").select("source_file", "locale")
    # one row per workbook, joined back to every row of it
    return join_small(t, vote, ["source_file"]).select(
        "o_orderkey", "source_file", "amount_text", "locale",
        N.parse_number_with_vote("amount_text", "locale").alias("monto_ui"),
    )


# ---- F4 (text) ------------------------------------------------------------
# Ship dates written in one text style per (return flag, line status), some
# lines with the month's name and some as six digits.
_DATE_STYLES = {
    ("A", "F"): ("d/M/yyyy", "%-d/%-m/%Y"),
    ("A", "O"): ("dd.MM.yy", "%d.%m.%y"),
    ("N", "F"): ("yyyy-MM-dd", "%Y-%m-%d"),
    ("N", "O"): ("ddMMyyyy", "%d%m%Y"),
    ("R", "F"): ("M/d/yyyy", "%-m/%-d/%Y"),
    ("R", "O"): ("yyyyMMdd HH:mm:ss", "%Y%m%d %H:%M:%S"),
}


def _date_text_spark():
    d = F.to_date("l_shipdate")
    out = None
    for (rf, ls), (spark_fmt, _) in _DATE_STYLES.items():
        cond = (F.col("l_returnflag") == rf) & (F.col("l_linestatus") == ls)
        txt = F.date_format(F.col("l_shipdate"), spark_fmt) if "HH" in spark_fmt else F.date_format(d, spark_fmt)
        out = F.when(cond, txt) if out is None else out.when(cond, txt)
    month = F.element_at(F.array(*[F.lit(names[0]) for names in MONTH_NAMES]), F.month(d))
    named = F.concat_ws(" de ", F.day(d), month, F.year(d))
    six = F.date_format(d, "ddMMyy")
    return F.when(F.col("l_linenumber") == 3, named).when(F.col("l_linenumber") == 5, six).otherwise(out)


def _date_text_sql() -> str:
    arms = " ".join(
        f"WHEN l_returnflag = '{rf}' AND l_linestatus = '{ls}' THEN strftime(l_shipdate, '{fmt}')"
        for (rf, ls), (_, fmt) in _DATE_STYLES.items()
    )
    months = ", ".join(O.q(names[0]) for names in MONTH_NAMES)
    named = f"concat_ws(' de ', day(l_shipdate), [{months}][month(l_shipdate)], year(l_shipdate))"
    return (f"(CASE WHEN l_linenumber = 3 THEN {named} WHEN l_linenumber = 5 THEN strftime(l_shipdate, '%d%m%y') "
            f"ELSE CASE {arms} END END)")


@register("date_text_roundtrip", f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_date_text_sql()} AS date_text FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_text, {O.parse_date_text('date_text')} AS fecha
FROM t""")
def q_date_text_roundtrip(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_returnflag", "l_linestatus", "l_shipdate"])
    t = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _date_text_spark().alias("date_text"))
    return D.with_parsed_date(t, "date_text", "fecha")


# ---- F4 (serials) ---------------------------------------------------------
@register("excel_serial_dates", """
WITH t AS (SELECT o_orderkey,
                  date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) + 0.75 AS serial
           FROM orders)
SELECT o_orderkey, serial,
       DATE '1899-12-30' + CAST(floor(serial) AS INTEGER) AS fecha_numero,
       DATE '1899-12-30' + CAST(floor(serial) AS INTEGER) AS fecha_texto
FROM t""")
def q_excel_serial_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    t = o.select(
        "o_orderkey",
        (F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")) + F.lit(0.75)).alias("serial"),
    )
    t = t.select(
        "o_orderkey",
        "serial",
        D.cell_date(F.lit("number"), F.lit(None), "serial", F.lit(None)).alias("fecha_numero"),
        F.floor("serial").cast("string").alias("_serial_text"),
    )
    # a serial typed as text (5 digits) is decoded too
    return D.with_parsed_date(t, "_serial_text", "fecha_texto").drop("_serial_text")


# ---- P1 -------------------------------------------------------------------
@register("drop_blank_rows", f"""
WITH raw AS (
  SELECT event_id,
         {O.norm_rut("CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) END")} AS rut,
         {O.norm_codigo("CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END")} AS codigo,
         nullif({O.norm_ministerio("CASE WHEN event_type = 'error' THEN props END")}, '') AS ministerio_evaluador,
         CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END AS fecha_presentado,
         CASE WHEN event_type = 'purchase' THEN value END AS monto_ui,
         nullif({O.as_text('event_type')}, '') AS regimen,
         nullif({O.as_text('props')}, '') AS tramo
  FROM events)
SELECT * FROM raw
WHERE NOT (rut IS NULL AND codigo IS NULL AND ministerio_evaluador IS NULL
           AND fecha_presentado IS NULL AND monto_ui IS NULL)""")
def q_drop_blank_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    reg = standardize(
        e,
        rut=F.when(et == "signup", F.col("user_id")),
        codigo=F.when(et == "purchase", F.col("event_id")),
        ministerio_evaluador=F.when(et == "error", F.col("props")),
        fecha_presentado=F.when(et == "click", F.to_date("ts")),
        monto_ui=F.when(et == "purchase", F.col("value")),
        regimen=et,
        tramo=F.col("props"),
        extra={"event_id": F.col("event_id")},
    )
    return reg.select("event_id", "rut", "codigo", "ministerio_evaluador", "fecha_presentado",
                      "monto_ui", "regimen", "tramo")
