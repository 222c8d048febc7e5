"""Licence scan by canonical digest.

A text is brought to canonical form line by line: lower case, copyright lines dropped, equivalent spellings unified,
everything but letters and digits one space.  The digest of an entire canonical text is looked up by a hash join with
the digests of known licence texts and notices, canonical by the same expression.  A document is looked up as a whole, by
paragraphs (between blank lines), by lines, and by runs of paragraphs: where a paragraph is the first of a known text,
it and as many of the next as that text has are looked up together.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.llm.license_texts import TEXTS

# Equivalent spellings, applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("organisation", "organization"), ("recognise", "recognize"),
    ("favour", "favor"), ("judgement", "judgment"), ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"), ("copyright holder", "copyright owner"), ("https:", "http:"), ("&", " and "),
)

# SPDX identifiers with public licence texts and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN = (
    ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT), ("MIT", _MIT),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_REST),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_REST),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_REST),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "This work is licensed under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."), ("ISC", "Released under the ISC License."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)

COPYRIGHT_LINE = r"^[^a-z0-9]*(copyright|\(c\)|©)[^a-z0-9]*(\(c\)|©|[0-9]|by |the ).*$|^[^a-z0-9]*all rights reserved[^a-z0-9]*$"
OTHER = "[^\\p{L}\\p{N}]+"


def canonical_line(line):
    """Canonical form of one line; empty for copyright lines."""
    text = F.lower(line)
    kept = F.when(F.rlike(text, F.lit(COPYRIGHT_LINE)), "").otherwise(text)
    for old, new in SPELLINGS:
        kept = F.replace(kept, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(kept, OTHER, " "))


def _joined(lines):
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def _paragraphs(lines):
    """Canonical lines joined, cut where a line is empty."""
    marked = F.split(F.array_join(F.transform(lines, lambda x: F.when(x == "", F.lit("\n")).otherwise(x)), " "), " ?\n[\n ]*")
    return F.filter(marked, lambda p: p != "")


def _known_lines(spark: SparkSession, known: tuple) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in known))
    return spark.range(1).select(F.inline(rows)).select("license_id", F.transform(F.split("text", "\n"), canonical_line).alias("lines"))


def known_digests(spark: SparkSession, known: tuple = KNOWN + TEXTS) -> DataFrame:
    """(license_id, digest) of the known texts, a fixed table."""
    return _known_lines(spark, known).select("license_id", F.sha2(_joined("lines"), 256).alias("digest")).distinct()


def known_runs(spark: SparkSession, known: tuple = KNOWN + TEXTS) -> DataFrame:
    """(first, size) of the known texts of several paragraphs: the digest of the first one, and their number."""
    texts = _known_lines(spark, known).select(_paragraphs("lines").alias("p")).where("size(p) > 1")
    return texts.select(F.sha2(texts.p[0], 256).alias("first"), F.size("p").alias("size")).distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         runs: DataFrame | None = None) -> DataFrame:
    """One row per doc_id: doc_id, licenses (distinct identifiers in code point order, joined by commas; empty if none),
    n_notices (its distinct matching paragraphs and lines, other than the whole text), whole_text (the entire text is a licence).

    A licence found as a run of paragraphs is among the identifiers, and no notice of its own.

    ``known``: (license_id, digest), by default the fixed table (a few dozen rows, broadcast; a larger table is joined as
    Spark sees fit).  ``runs``: (first, size) as ``known_runs`` gives them, one small table that every task gets; with a
    ``known`` of the caller's and without ``runs``, runs of paragraphs are not looked up.  Null or empty text matches nothing.  Rows that share a doc_id, and rows with a null one, are taken
    together as one document.  Other columns are ignored; an empty table gives an empty result.
    """
    if known is None:
        known = F.broadcast(known_digests(docs.sparkSession))
        runs = known_runs(docs.sparkSession) if runs is None else runs
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    lines = docs.select("doc_id", F.transform(F.split("text", "\r\n|\n|\r"), canonical_line).alias("lines"))
    paragraphs = _paragraphs("lines")
    none = F.array().cast("array<string>")
    parts = F.when(F.size("lines") > 1, F.array_union(F.when(F.size(paragraphs) > 1, paragraphs).otherwise(none), "lines")).otherwise(none)
    together = F.array().cast("array<struct<kind:string,unit:string>>")
    if runs is not None:
        # a fixed, small table: one row for all tasks
        lines = lines.crossJoin(F.broadcast(runs.agg(F.collect_list(F.struct("first", "size")).alias("runs"))))
        together = F.when(F.size(paragraphs) > 1, F.flatten(F.transform(F.transform(paragraphs, lambda p: F.sha2(p, 256)), lambda d, i: F.transform(
            F.filter("runs", lambda r: r["first"] == d),
            lambda r: F.struct(F.lit("run").alias("kind"), F.array_join(F.slice(paragraphs, i + 1, r["size"]), " ").alias("unit")),
        )))).otherwise(together)
    units = lines.select("doc_id", F.explode(F.concat(
        F.array(F.struct(F.lit("whole").alias("kind"), _joined("lines").alias("unit"))),
        F.transform(parts, lambda p: F.struct(F.lit("part").alias("kind"), p.alias("unit"))),
        together,
    )).alias("u")).select("doc_id", "u.kind", "u.unit")
    units = units.where("unit <> ''").select("doc_id", "kind", F.sha2("unit", 256).alias("digest"))
    hits = units.join(known, "digest").groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("licenses"),
        F.sum(F.when(F.col("kind") == "part", 1).otherwise(0)).alias("n_notices"),
        F.max(F.col("kind") == "whole").alias("whole_text"),
    )
    ids, h = docs.select("doc_id").distinct().alias("i"), hits.alias("h")
    return ids.join(h, F.col("i.doc_id").eqNullSafe(F.col("h.doc_id")), "left").select(
        "i.doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"), F.coalesce("whole_text", F.lit(False)).alias("whole_text"),
    )
