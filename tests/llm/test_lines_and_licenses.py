"""Line dedup and licence scan: cases, edge rows, and the SQL."""

import re

from pyspark.sql import functions as F

from regfuse.llm import licenses, line_dedup

NOTICE = "Accept our cookies to read on please"


def lines(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id bigint, text string, leaf string, line int")
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup(df, **options).collect()), key=repr)


def test_exact_and_masked_lines(spark):
    rows = [(1, f"alpha beta\n{NOTICE}\n\nPosted at 10:45 by ann@x.org"), (2, f"gamma\n {NOTICE} \nPosted at 9:01 by bob@y.com"), (3, "delta\ndelta"), (4, f"{NOTICE}")]
    assert lines(spark, rows) == [
        (1, f"alpha beta\n{NOTICE}\n\nPosted at 10:45 by ann@x.org", 3, 0),  # the first of each template stays
        (2, "gamma", 3, 2), (3, "delta\ndelta", 2, 0), (4, "", 1, 1),
    ]


def test_generalised_template(spark):
    names = ["anna", "bert", "carl", "dora", "emil"]
    rows = [(i, f"own text {n} {i}x\nThis page was written by {n} for our readers today") for i, n in enumerate(names)]
    got = lines(spark, rows)
    assert [r[3] for r in got] == [0, 1, 1, 1, 1]
    assert got[3][1] == "own text dora 3x"
    assert sum(r[3] for r in lines(spark, rows, similarity=0.95)) == 0


def test_line_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "same line here"), (None, "same line here"), (5, "once"), (5, "once"), (6, "a" * 300_000)]
    got = lines(spark, rows)
    assert (1, None, 0, 0) in got and (2, "", 0, 0) in got and (3, "\n\n", 0, 0) in got and (6, "a" * 300_000, 1, 0) in got
    assert got.count((None, "same line here", 1, 0)) == 2 and got.count((5, "once", 1, 0)) == 2  # one document each
    assert lines(spark, []) == []


def test_lines_that_share_only_their_path_stay(spark):
    rows = [(1, "I would like tea"), (2, "I would like coffee"), (3, "I would like water"), (4, "a b c"), (5, "a b d")]
    assert [r[3] for r in lines(spark, rows)] == [0, 0, 0, 0, 0]
    short = [(i, f"we saw it {n} once") for i, n in enumerate(["here", "there", "nowhere", "again"])]
    assert [r[3] for r in lines(spark, short)] == [0, 0, 0, 0]  # one of two places beyond the path agrees
    fields = [(1, "we saw it 5 green"), (2, "we saw it 6 blue"), (3, "we saw it 7 red")]
    assert [r[3] for r in lines(spark, fields)] == [0, 0, 0]  # a masked field is no evidence


def test_rows_that_share_an_id_are_told_apart_by_their_texts(spark):
    rows = [(1, f"{NOTICE}\nfirst own line"), (7, f"x\n{NOTICE}"), (7, "y\nunique second line"), (None, f"z\n{NOTICE}"), (None, "w\nother second line")]
    got = lines(spark, rows)
    assert (7, "y\nunique second line", 2, 0) in got and (None, "w\nother second line", 2, 0) in got
    assert (7, "x", 2, 1) in got and (None, f"z\n{NOTICE}", 2, 0) in got and (1, "first own line", 2, 1) in got


def test_masked_lines(spark):
    def expected(line):  # token by token
        tokens = [t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t]
        return " ".join("<*>" if re.search(r"[0-9@]|://", t) else t for t in tokens)

    raw = [
        "", " \t ", "plain words", "  two  spaces\tand tab\r", "at 10:45 by ann@x.org", "see http://x.org/a now", "a:b c:/d :// e: /f", "x1 2y :z: ::// é5é \u00a07",
        "a://b://c d", "9", "<*> 1", "note: //", "é ü\u2003@", "a" * 300_000, "a" * 300_000 + "1", ":" * 300_000, "b " * 50_000 + "7",
    ]
    df = spark.createDataFrame([(x,) for x in raw], "raw string")
    got = df.select("raw", line_dedup.masked_line(F.col("raw")).alias("m"), line_dedup.worded(F.col("raw")).alias("w")).collect()
    assert {r.raw: r.m for r in got} == {x: expected(x) for x in raw}
    assert all(r.w == (r.m != "") for r in got)


def test_lines_are_masked_once(spark):
    docs = line_dedup.keyed(spark.createDataFrame([(1, "a b 1")], "doc_id bigint, text string"), "doc_id", "text")
    plan = line_dedup.lines_of(docs)._jdf.queryExecution().executedPlan().toString()
    filters = [p for p in plan.splitlines() if "Filter" in p]
    assert filters and not any("regexp_replace" in p or "RLIKE" in p for p in filters) and "lambda" not in plan


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, digest string, license_id string")
    return sorted((tuple(r) for r in licenses.scan(df).collect()), key=repr)


def test_licenses(spark):
    mit = licenses.KNOWN[0][1]
    loud = mit.upper().replace("SUBLICENSE", "SUB-LICENSE").replace(",", " ,")
    with_holder = mit.replace("\n\n", "\n\nCopyright (c) 2020 Some Body\n\n", 1)
    rows = [(1, mit), (2, loud), (3, with_holder), (4, "words\nReleased under the MIT Licence\nmore\nLICENSED UNDER CC BY-NC 4.0.")]
    rows += [(5, "Licensed under the MIT License, mostly"), (6, None), (7, ""), (8, "Licensed under CC BY 4.0."), (9, "Licensed under CC BY 4.0."), (9, "x\n\nReleased under the MIT License.")]
    rows += [(None, "Released under the ISC License."), (10, "some prose, " * 50_000), (11, mit.replace("free of charge", "for a fee"))]
    got = {r[0]: r[1:] for r in found(spark, rows)}
    assert got[1][0] == got[2][0] == got[3][0] == "MIT" and got[1][2] and got[2][2] and got[3][2]
    assert got[4] == ("CC-BY-NC-4.0,MIT", 2, False)
    assert got[5] == got[6] == got[7] == got[10] == got[11] == ("", 0, False)
    assert got[8] == ("CC-BY-4.0", 0, True) and got[9] == ("CC-BY-4.0,MIT", 1, True) and got[None] == ("ISC", 0, True)
    assert found(spark, []) == []


def test_complete_texts_and_runs_of_paragraphs(spark):
    ids = sorted({i for i, _ in licenses.TEXTS})
    assert ids == ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "MPL-2.0"]
    rows, want = [], {}
    for k, (i, text) in enumerate(licenses.TEXTS):
        rows += [(2 * k, text), (2 * k + 1, f"# A readme\n\nSome words.\n\n{text}\n\nThe end.")]
        want |= {2 * k: (i, True), 2 * k + 1: (i, False)}
    mit = licenses.KNOWN[2][1]
    rows += [(900, f"# A readme\n\nCopyright (c) 2020 Some Body\n\n{mit}"), (901, f"Words.\n\n{mit.rsplit(chr(10), 2)[0]}"), (902, f"Words.\n\n{mit}\n\n{rows[0][1]}")]
    rows += [(903, mit.replace("\n\n", "\n\nOther words.\n\n"))]
    want |= {900: ("MIT", False), 901: ("", False), 902: ("Apache-2.0,MIT", False), 903: ("", False)}
    assert {r[0]: (r[1], r[3]) for r in found(spark, rows)} == want
