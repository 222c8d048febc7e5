"""Registers derived from the driver's star-schema tables.

The test tables stand in for the two workbooks:

* presented register = ``orders``; a pending order (``o_orderstatus = 'P'``) has
  no company id yet, so it is a presented row without a key, and its lines are
  the recommendation-only population;
* recommended register = ``lineitem`` joined to its order for the customer.

Field mapping (both registers go through the same normalisers as workbook
rows):

=====================  ==========================  =============================
canonical field        presented (orders)          recommended (lineitem)
=====================  ==========================  =============================
rut                    o_custkey, none if pending  o_custkey of the line's order
codigo           o_orderkey                  l_orderkey
empresa                customer label of custkey   same
ministerio_evaluador   o_orderpriority             o_orderpriority
fecha_presentado       o_orderdate                 -
fecha_recomendado      -                           l_shipdate, none for returns (R)
regimen                -                           l_returnflag
tramo                  o_orderstatus               l_linestatus
monto_ui               o_totalprice                l_extendedprice
file order             o_orderkey                  (l_orderkey, l_linenumber,
                                                    l_partkey, l_suppkey,
                                                    l_extendedprice)
=====================  ==========================  =============================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.operators.register import standardize
from regfuse.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", columns)


def _company_label(custkey) -> F.Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(custkey).cast("string"), 9, "0"))


def presented_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return standardize(
        o,
        rut=F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")),
        codigo=F.col("o_orderkey"),
        empresa=_company_label("o_custkey"),
        ministerio_evaluador=F.col("o_orderpriority"),
        fecha_presentado=F.to_date("o_orderdate"),
        tramo=F.lower("o_orderstatus"),
        monto_ui=F.col("o_totalprice"),
        source_file=F.lit("orders"),
        source_path=F.lit(f"{sf_dir}/orders.parquet"),
        source_header_row=F.lit(1),
        source_row=F.col("o_orderkey"),
        order=F.col("o_orderkey"),
    )


def recommended_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ])
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")  # a line without an order is a row without company and ministry
    return standardize(
        j,
        rut=F.col("o_custkey"),
        codigo=F.col("l_orderkey"),
        empresa=_company_label("o_custkey"),
        ministerio_evaluador=F.col("o_orderpriority"),
        fecha_recomendado=F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate")),
        regimen=F.col("l_returnflag"),
        tramo=F.lower("l_linestatus"),
        monto_ui=F.col("l_extendedprice"),
        source_file=F.lit("lineitem"),
        source_path=F.lit(f"{sf_dir}/lineitem.parquet"),
        source_sheet=F.col("l_orderkey").cast("string"),
        source_header_row=F.lit(1),
        source_row=F.col("l_linenumber"),
        order=F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
    )


def registers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both registers, lazily: no job runs before an action on the result, and nothing is pinned."""
    return presented_register(spark, sf_dir), recommended_register(spark, sf_dir)
