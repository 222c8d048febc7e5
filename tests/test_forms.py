"""Company search, lineage bitmaps and form versions against plain Python."""

import random

from pyspark.sql import functions as F

from regfuse.operators import lineage, search, versions

NAMES = ["Ñandú S.A.", "La Estancia S.A.", "estancia el ombú", "Ombú & Cía", "AB", "a-b", "X", "", None, "Straße 12", "12 de Octubre"]
TERMS = ["ombu", "Estancia", "s a", "b", "ab", "A B", "nandú", "12", "no such", "", "--", None, "x", "strasse 12"]


def test_search_equals_contains_for_every_term(spark):
    companies = spark.createDataFrame([(str(i), n, "extra") for i, n in enumerate(NAMES * 2)] + [(None, "Ombú", "x")], "rut string, empresa string, term string")
    terms = spark.createDataFrame([(t,) for t in TERMS + TERMS], "term string")
    got = {tuple(r) for r in search.search(search.build_index(companies), terms).collect()}
    from regfuse.functions import text as tx

    pairs = companies.select("rut", "empresa").crossJoin(terms.distinct())
    wanted = tx.normalize_name("term")
    hit = F.coalesce(tx.normalize_name("empresa").contains(wanted), F.lit(False)) | F.coalesce(F.col("rut") == tx.normalize_rut("term"), F.lit(False))
    want = {tuple(r) for r in pairs.where((wanted != "") & hit).select("term", "rut", "empresa").collect()}
    assert got == want and len(want) > 30


def test_search_reads_the_rarest_part_only(spark):
    companies = spark.range(3000).select(F.col("id").cast("string").alias("rut"), F.concat(F.lit("empresa numero "), F.col("id")).alias("empresa"))
    index = search.build_index(companies)
    assert index.counts.where("gram = 'emp'").first().n == 3000
    found = search.search(index, spark.createDataFrame([("numero 2999",)], "term string")).collect()
    assert [r.empresa for r in found] == ["empresa numero 2999"]
    assert search.search(search.build_index(companies.where("false")), spark.createDataFrame([("a",)], "term string")).collect() == []


def test_lineage_bitmaps(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), f"f{i % 7}") for i in rng.sample(range(1, 100_000), 4000)] + [(None, "a", "x", "f")]
    rows += [(lineage.BITS, "a", "x", "f"), (lineage.BITS + 1, "a", "y", "f"), (1, "b", "x", "f")]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "project_row_id bigint, m string, s string, source_file string").repartition(4)
    bitmaps = lineage.cell_bitmaps(df, ["m", "s"])
    cells = {}
    for r in lineage.row_ids(bitmaps).collect():
        cells.setdefault((r.dimension, r.valor), set()).add(r.project_row_id)
    want = {("total", "total"): {r[0] for r in rows if r[0]}}
    for i, m, s, _ in rows:
        if i:
            want.setdefault(("m", m or "SIN_DATO"), set()).add(i)
            want.setdefault(("s", s), set()).add(i)
    assert cells == want
    assert {(r.dimension, r.valor): r.n for r in bitmaps.groupBy("dimension", "valor").agg(F.sum("n").alias("n")).collect()} == {
        k: len(v) for k, v in want.items()}
    ids = lambda d: {r.project_row_id for r in lineage.row_ids(d).collect()}
    pair = [("m", "a"), ("s", "x"), ("m", "a")]
    assert ids(lineage.all_of(bitmaps, pair)) == want[("m", "a")] & want[("s", "x")]
    assert ids(lineage.any_of(bitmaps, pair)) == want[("m", "a")] | want[("s", "x")]
    assert ids(lineage.all_of(bitmaps, [("m", "a"), ("m", "b")])) == set()
    behind = lineage.rows_behind(bitmaps.where("valor = 'b'"), df, columns=("source_file",)).collect()
    assert {(r.project_row_id, r.source_file) for r in behind} == {(r[0], r[3]) for r in rows if r[0] and r[1] == "b"}
    assert lineage.row_ids(lineage.cell_bitmaps(df.where("false"), ["m"])).collect() == []


def test_families_and_chains(spark):
    files = [("p/Presentados 2020.xlsx", 1, "h1"), ("p/presentados_v2.xlsm", 2, "h2"), ("p/Presentados (copia).xlsx", 3, "h2"),
             ("p/PRESENTADOS final.xlsx", 4, "h1"), ("q/presentados.xlsx", 1, "h1"), ("p/2020.xlsx", 1, None), ("Otros.xlsx", 9, "h")]
    chain = versions.version_chain(spark.createDataFrame(files, "path string, modificationTime int, content_hash string"))
    got = sorted(map(tuple, chain.collect()), key=lambda r: (r[0], r[2]))
    assert got == [
        ("/otros", "Otros.xlsx", 1, None), ("p/2020", "p/2020.xlsx", 1, None),
        ("p/presentados", "p/Presentados 2020.xlsx", 1, None), ("p/presentados", "p/presentados_v2.xlsm", 2, "p/Presentados 2020.xlsx"),
        ("p/presentados", "p/PRESENTADOS final.xlsx", 3, "p/presentados_v2.xlsm"), ("q/presentados", "q/presentados.xlsx", 1, None)]


def test_differences_of_repeated_keys_and_nulls(spark):
    one = [("a", 1), ("a", 1), ("b", 2), ("c", None), ("d", 4), (None, 5), ("e", 1), ("e", 2)]
    two = [("a", 1), ("b", 2), ("c", 3), (None, 5), ("f", 6), ("e", 2), ("e", 1)]
    rows = spark.createDataFrame([("v1", *r) for r in one] + [("v2", *r) for r in two], "path string, k string, x int")
    chain = spark.createDataFrame([("f", "v1", 1, None), ("f", "v2", 2, "v1")], "family string, path string, version int, previous_path string")
    got = {(r.k, r.change) for r in versions.version_diff(rows, chain, ["k"], ["x"]).collect()}
    assert got == {("a", "changed"), ("c", "changed"), ("d", "removed"), ("f", "added")}
    assert versions.version_diff(rows.where("false"), chain, ["k"], ["x"]).collect() == []
