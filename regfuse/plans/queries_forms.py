"""Search of many companies, lineage of indicator cells, versions of forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from regfuse.operators import consolidate, lineage, replacement, search, versions
from regfuse.plans import oracle as O
from regfuse.plans import standins
from regfuse.plans.registry import register
from regfuse.plans.standins import table
from regfuse.session import materialize

DIMENSIONS = ["ministerio_evaluador", "match_method", "regimen"]

# ---- D10 --------------------------------------------------------------------
_COMPANIES = """companies AS (SELECT CAST(c_custkey AS VARCHAR) AS rut, c_name AS empresa FROM customer
  UNION SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier UNION SELECT 'P' || CAST(p_partkey AS VARCHAR), p_name FROM part)"""
_TERMS = """terms AS (SELECT substr(p_name, 3, 5) AS term FROM part UNION SELECT upper(substr(n_name, 1, 2)) FROM nation
  UNION SELECT substr(c_name, 13, 6) FROM customer WHERE c_custkey % 50 = 0 UNION SELECT 'Nº ' || CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION SELECT '-- ' UNION SELECT 'zzz')"""


@register("company_search", f"""WITH {_COMPANIES}, {_TERMS},
n AS (SELECT *, {O.norm_name('empresa')} AS name FROM companies),
t AS (SELECT term, {O.norm_name('term')} AS wanted, {O.norm_rut('term')} AS digits FROM terms)
SELECT DISTINCT term, rut, empresa FROM t JOIN n ON contains(name, wanted) OR rut = digits WHERE wanted <> ''""")
def q_company_search(spark, sf_dir):
    """Customers, suppliers and parts are the companies; the terms are parts of their names and numbers."""
    part, customer, supplier = (table(spark, sf_dir, t) for t in ("part", "customer", "supplier"))
    nation = table(spark, sf_dir, "nation")
    companies = customer.select(F.col("c_custkey").cast("string").alias("rut"), F.col("c_name").alias("empresa")).union(
        supplier.select(F.col("s_suppkey").cast("string"), "s_name")).union(
        part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")), "p_name"))
    terms = part.select(F.substring("p_name", 3, 5).alias("term")).union(
        nation.select(F.upper(F.substring("n_name", 1, 2)))).union(
        customer.where("c_custkey % 50 = 0").select(F.substring("c_name", 13, 6))).union(
        supplier.select(F.concat(F.lit("Nº "), F.col("s_suppkey").cast("string")))).union(
        spark.createDataFrame([("-- ",), ("zzz",)], "term string"))
    return search.search(search.build_index(companies), terms)


# ---- D5 D12 -----------------------------------------------------------------
def _auth(spark, sf_dir, *columns):
    p, r = standins.registers(spark, sf_dir)
    return consolidate.authoritative(p, r, with_ids=True, sort=False, columns=(*DIMENSIONS, *columns))  # written as it is numbered


_CELLS = " UNION ALL ".join(
    [f"SELECT '{d}' AS dimension, coalesce({d}, 'SIN_DATO') AS valor, * FROM auth" for d in DIMENSIONS] + ["SELECT 'total', 'total', * FROM auth"])


@register("metric_lineage", f"""WITH {O.linkage_cte()}
SELECT dimension, valor, project_row_id, source_file, source_sheet, source_row FROM ({_CELLS}) WHERE has_benefits""")
def q_metric_lineage(spark, sf_dir):
    auth = _auth(spark, sf_dir, "has_benefits", "source_file", "source_sheet", "source_row")
    bitmaps = lineage.cell_bitmaps(auth, DIMENSIONS, only=F.col("has_benefits"))
    return lineage.rows_behind(bitmaps, auth)


@register("combined_lineage", f"""WITH {O.linkage_cte()}
SELECT 'all' AS cells, project_row_id FROM auth WHERE match_method = 'recomendado_only' AND regimen = 'A'
UNION ALL SELECT 'any', project_row_id FROM auth WHERE match_method = 'recomendado_only' OR regimen IS NULL""")
def q_combined_lineage(spark, sf_dir):
    bitmaps = materialize(lineage.cell_bitmaps(_auth(spark, sf_dir), DIMENSIONS))
    only = ("match_method", "recomendado_only")
    both = lineage.row_ids(lineage.all_of(bitmaps, [only, ("regimen", "A")]))
    either = lineage.row_ids(lineage.any_of(bitmaps, [only, ("regimen", "SIN_DATO")]))
    return both.select(F.lit("all").alias("cells"), "project_row_id").unionByName(either.select(F.lit("any").alias("cells"), "project_row_id"))


# ---- D8 ---------------------------------------------------------------------
# Three versions of a form per return flag: the second lacks first lines and has other quantities, the third has the second's
# prices rounded for some parts; a copy of the second lies between them.
_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@register("form_versions", """
WITH v1 AS (SELECT *, 1 AS v FROM lineitem WHERE l_linenumber < 6),
v2 AS (SELECT * REPLACE (CASE WHEN l_partkey % 9 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity), 2 AS v FROM lineitem WHERE l_linenumber > 1),
v3 AS (SELECT * REPLACE (CASE WHEN l_suppkey % 7 = 0 THEN round(l_extendedprice) ELSE l_extendedprice END AS l_extendedprice, 3 AS v) FROM v2),
rows AS (SELECT * FROM v1 UNION ALL SELECT * FROM v2 UNION ALL SELECT * FROM v3),
c AS (SELECT 'registro/' || lower(l_returnflag) || '/presentados' AS family, v, l_orderkey, l_partkey, l_suppkey, l_linenumber,
        list_sort(list(row(l_quantity, l_extendedprice))) AS content FROM rows GROUP BY ALL),
sides AS (SELECT *, v AS version, TRUE AS is_new FROM c WHERE v > 1 UNION ALL SELECT *, v + 1, FALSE FROM c WHERE v < 3),
d AS (SELECT family, version::INTEGER AS version, l_orderkey, l_partkey, l_suppkey, l_linenumber,
        any_value(content) FILTER (WHERE is_new) AS n, any_value(content) FILTER (WHERE NOT is_new) AS o
      FROM sides GROUP BY ALL)
SELECT family, version, l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM d WHERE n IS DISTINCT FROM o""")
def q_form_versions(spark, sf_dir):
    columns = [*_KEY, "l_returnflag", "l_quantity", "l_extendedprice"]
    li = table(spark, sf_dir, "lineitem", columns)
    more = F.when(F.col("l_partkey") % 9 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    price = F.when(F.col("l_suppkey") % 7 == 0, F.round("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    second = li.where("l_linenumber > 1").withColumn("l_quantity", more)
    names = {"Presentados.xlsx": li.where("l_linenumber < 6"), "Presentados v2.xlsx": second, "presentados (copia).xlsx": second,
             "PRESENTADOS_2021 final.xlsx": second.withColumn("l_extendedprice", price)}
    rows, files = None, None
    for i, (name, df) in enumerate(names.items()):
        part = df.withColumn("path", F.concat(F.lit("registro/"), F.lower("l_returnflag"), F.lit(f"/{name}")))
        content = F.sum(F.xxhash64(*_KEY, "l_quantity", "l_extendedprice").cast("decimal(38,0)")).alias("content_hash")
        own = part.groupBy("path").agg(content).withColumn("modificationTime", F.lit(i))
        rows, files = (part, own) if rows is None else (rows.unionByName(part), files.unionByName(own))
    chain = versions.version_chain(files)
    return versions.version_diff(rows, chain, _KEY, ["l_quantity", "l_extendedprice"])


# ---- D4 D6 ------------------------------------------------------------------
# A workbook per customer: its orders up to a day are its rows, the last order's day is its time, its finished orders are its
# content.  Between the two listings orders were added, and the workbooks of one market segment were taken away.
_WORKBOOK = """SELECT 'c' || o_custkey AS path, max(o_orderdate) AS t, count(*) AS length,
    count(*) FILTER (o_orderstatus = 'F') AS content FROM orders WHERE o_orderdate < DATE '{}' {} GROUP BY o_custkey"""


@register("replaced_workbooks", f"""WITH before AS ({_WORKBOOK.format('1995-06-01', '')}),
after AS ({_WORKBOOK.format('1997-01-01', "AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")}),
f AS (SELECT coalesce(a.path, b.path) AS path, a.length AS now_n, b.length AS old_n,
  CASE WHEN b.path IS NULL THEN 'new' WHEN a.path IS NULL THEN 'removed' WHEN a.t = b.t AND a.length = b.length THEN 'unchanged'
       WHEN a.content = b.content THEN 'touched' ELSE 'replaced' END AS change FROM after a FULL JOIN before b ON a.path = b.path)
SELECT path, change, CASE WHEN change = 'removed' THEN 0 WHEN change IN ('new', 'replaced') THEN now_n ELSE old_n END AS n_rows FROM f""")
def q_replaced_workbooks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("path", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    gone = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    first = orders.where("o_orderdate < date'1995-06-01'")
    second = orders.where("o_orderdate < date'1997-01-01'").join(gone, "o_custkey", "left_anti")

    def listing(rows):
        content = F.count_if(F.col("o_orderstatus") == "F").cast("string").alias("content_hash")
        return rows.groupBy("path").agg(F.max("o_orderdate").cast("timestamp").alias("modificationTime"), F.count(F.lit(1)).alias("length"), content)

    state = listing(first).withColumn("rows_at", F.lit("first"))
    after = listing(second)
    done = materialize(replacement.outcomes(state, replacement.changed_files(after, state), after, "second"))
    rows = first.withColumn("rows_at", F.lit("first")).unionByName(second.withColumn("rows_at", F.lit("second")))
    current = replacement.current_rows(rows, replacement.next_state(state, done), "path").groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    known = state.select("path").union(after.select("path")).distinct()
    return known.join(done, "path", "left").join(current, "path", "left").select(
        "path", F.coalesce("change", F.lit("unchanged")).alias("change"), F.coalesce("n", F.lit(0)).alias("n_rows"))
