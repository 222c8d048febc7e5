"""Header inference over workbook rows, as one fold per sheet.

Input is a *rows* DataFrame (``ROWS_SCHEMA``): one row per non-empty sheet row with its cells as ``map<col_idx, cell>``.

* ``preview``        the first ``PREVIEW_ROWS`` rows of every sheet, by a rank with a limit on the map side: each task keeps
                     that many rows a sheet, so only those are exchanged, and data rows are read once
* ``sheets``         one row per sheet.  Every preview row is scored against the alias catalogue (count of fields it
                     resolves); one aggregation keeps the best row (ties: the first) and the first row, which is taken if the
                     best scores below 2; the chosen row's names are repaired and resolved to fields as bounded arrays (at most
                     a sheet's columns, at most a struct per field)
* ``choose_sheets``  per (file, dataset): the sheet resolving most expected fields, ties to the first sheet, with
                     ``mapping: map<field, col_idx>``
* ``canonical_cells``  data rows below the header with one cell per field (a map lookup per row after a join with the
                     chosen sheets)

The fold needs the exchange of the preview and nothing else: its grouping key is the rank's.  Choosing sheets joins it with the
files, so inference has three exchanges, whatever the number of fields.  ``header_rows``, ``header_names`` and
``resolved_columns`` are long forms of ``sheets``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regfuse.functions import text as tx
from regfuse.functions.constants import (
    CANONICAL_FIELDS,
    COLUMN_ALIASES,
    DATASET_EXCLUDED_FIELD,
    MIN_HEADER_SCORE,
    PREVIEW_ROWS,
)

CELL_TYPE = T.StructType(
    [
        T.StructField("cell_type", T.StringType()),   # text | number | date | bool | error
        T.StructField("text", T.StringType()),
        T.StructField("num", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

ROWS_SCHEMA = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
        T.StructField("sheet_idx", T.IntegerType()),
        T.StructField("row_idx", T.IntegerType()),
        T.StructField("cells", T.MapType(T.IntegerType(), CELL_TYPE)),
        T.StructField("date1904", T.BooleanType()),  # serials count from 1904
    ]
)

SHEET_KEY = ["source_path", "source_sheet"]


def cell_text(cell) -> Column:
    """Text form of a typed cell (numbers exact, no scientific notation)."""
    c = F.col(cell) if isinstance(cell, str) else cell
    t = c.getField("cell_type")
    return (
        F.when(t == "error", F.lit(None).cast("string"))  # an error is a missing value
        .when(t == "number", tx.num_to_text(c.getField("num")))
        .when(t == "date", F.date_format(c.getField("ts"), "yyyy-MM-dd"))
        .otherwise(c.getField("text"))
    )


def preview(rows: DataFrame, preview_rows: int = PREVIEW_ROWS) -> DataFrame:
    """Each sheet's rows from its first non-empty row on, ``preview_rows`` row numbers far, with ``first_row``.

    A sheet has at most one row per row number, so the window holds the rows of rank 1 to ``preview_rows``."""
    w = Window.partitionBy(*SHEET_KEY).orderBy("row_idx")
    ranked = rows.select(
        *SHEET_KEY, "sheet_idx", "row_idx", "cells", F.row_number().over(w).alias("_rank"),
        F.first("row_idx").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("first_row"),
    )
    near = (F.col("_rank") <= preview_rows) & (F.col("row_idx") < F.col("first_row") + preview_rows)
    return ranked.where(near).drop("_rank")


def _named_cells(cells: Column) -> Column:
    """Non-blank cells in sheet order: array of (col_idx, raw text)."""
    entries = F.transform(F.map_entries(cells), lambda e: F.struct(e["key"].alias("col_idx"), cell_text(e["value"]).alias("raw")))
    return F.array_sort(F.filter(entries, lambda e: tx.has_text(e["raw"])))


def _any_of(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def row_score(cells: str, aliases=COLUMN_ALIASES) -> Column:
    """How many fields some normalised name of ``cells`` (an array of col_idx, raw) resolves, exactly or partly.

    A name holds no line break, so one text of all names is searched once per field."""
    names = F.array_join(F.transform(cells, lambda c: tx.normalize_name(c["raw"])), "\n")
    fields = F.transform(F.array(names), lambda n: sum(n.rlike(_any_of(words)).cast("int") for words in aliases.values()))
    return fields[0]


def _repaired_names(cells: str) -> Column:
    """(col_idx, raw, name) of the chosen row's cells: a raw name used by several columns gets its column number appended
    (``Fecha`` twice -> ``fecha_3``, ``fecha_7``), then names are normalised; those without letters or digits are left out."""
    by_raw = F.array_sort(F.transform(cells, lambda c: F.struct(c["raw"].alias("raw"), c["col_idx"].alias("col_idx"))))

    def named(sorted_):
        def one(c, i):
            same = (F.get(sorted_, i - 1)["raw"] == c["raw"]) | (F.get(sorted_, i + 1)["raw"] == c["raw"])
            repaired = F.when(F.coalesce(same, F.lit(False)), F.concat(c["raw"], F.lit("..."), c["col_idx"].cast("string")))
            return F.struct(c["col_idx"].alias("col_idx"), c["raw"].alias("raw"),
                            tx.normalize_name(F.coalesce(repaired, c["raw"])).alias("name"))

        return F.transform(sorted_, one)

    bound = F.transform(F.array(by_raw), named)[0]  # sorted once
    return F.array_sort(F.filter(bound, lambda c: c["name"] != ""))


def _resolved_field(names: str, field: str, words: list[str]) -> Column:
    place = F.array(*map(F.lit, words))
    hits = F.filter(names, lambda c: c["name"].rlike(_any_of(words)))

    def key(c):
        at = F.array_position(place, c["name"])  # 0: a partial match
        return F.struct((at == 0).alias("partial"), at.alias("priority"), c["col_idx"].alias("col_idx"), c["name"].alias("name"))

    def shown(b):
        out = F.struct(F.lit(field).alias("field"), b["col_idx"].alias("col_idx"), b["name"].alias("column_name"), (~b["partial"]).alias("exact"))
        return F.when(b.isNotNull(), out)

    return F.transform(F.array(F.array_min(F.transform(hits, key))), shown)[0]


def _resolved_fields(names: str, aliases=COLUMN_ALIASES) -> Column:
    """(field, col_idx, column_name, exact) of every field that some name resolves.  Exact beats partial; among exact the
    alias priority decides, then sheet order; among partial the sheet order."""
    return F.array_compact(F.array(*[_resolved_field(names, field, words) for field, words in aliases.items()]))


def sheets(rows: DataFrame, aliases=COLUMN_ALIASES, min_score: int = MIN_HEADER_SCORE, preview_rows: int = PREVIEW_ROWS) -> DataFrame:
    """One row per sheet: path, sheet, sheet_idx, first_row, header_row, header_score, names (col_idx, raw, name) and resolved
    (field, col_idx, column_name, exact).

    ``aliases``: {field: words in order of priority}.  An empty cell never resolves a field; a sheet none of whose rows resolves
    ``min_score`` fields has its first row as header."""
    scored = preview(rows, preview_rows).withColumn("named", _named_cells(F.col("cells"))).drop("cells")
    scored = scored.withColumn("score", row_score("named", aliases))
    candidate = F.struct("row_idx", "named")
    best = scored.groupBy(*SHEET_KEY).agg(
        F.min("sheet_idx").alias("sheet_idx"),
        F.min("first_row").alias("first_row"),
        F.max("score").alias("header_score"),
        F.max_by(candidate, F.struct("score", -F.col("row_idx"))).alias("best"),
        F.min_by(candidate, "row_idx").alias("first"),
    )
    header = F.when(F.col("header_score") >= min_score, F.col("best")).otherwise(F.col("first"))
    out = best.withColumn("header", header).select(
        *SHEET_KEY, "sheet_idx", "first_row", F.col("header.row_idx").alias("header_row"), "header_score", F.col("header.named").alias("named"))
    out = out.withColumn("names", _repaired_names("named")).drop("named")
    return out.withColumn("resolved", _resolved_fields("names", aliases))


def header_rows(sheet_rows: DataFrame) -> DataFrame:
    """(source_path, source_sheet, sheet_idx, first_row, header_row, header_score)."""
    return sheet_rows.drop("names", "resolved")


def header_names(sheet_rows: DataFrame) -> DataFrame:
    """(source_path, source_sheet, col_idx, raw, name): a row per named column of every sheet's header."""
    return sheet_rows.select(*SHEET_KEY, F.inline("names"))


def resolved_columns(sheet_rows: DataFrame) -> DataFrame:
    """(source_path, source_sheet, field, col_idx, column_name, exact): a row per resolved field of every sheet."""
    return sheet_rows.select(*SHEET_KEY, F.inline("resolved"))


def choose_sheets(sheet_rows: DataFrame, files: DataFrame, excluded=DATASET_EXCLUDED_FIELD) -> DataFrame:
    """Best sheet per (file, dataset), with all columns of ``files``, ``sheet_score``, ``resolved`` and ``mapping``.

    ``files``: (source_path, dataset, ...), a row each.  The score counts the fields resolved; each dataset ignores the other
    dataset's date field.  ``mapping`` has all fields (a missing one is absent: its value is NULL)."""
    dataset = F.col("dataset")
    skip = F.lit(None).cast("string")
    for name, field in excluded.items():
        skip = F.when(dataset == name, F.lit(field)).otherwise(skip)
    columns = ["source_sheet", "sheet_idx", "header_row", "header_score", "resolved"]
    cand = files.join(sheet_rows.select("source_path", *columns), "source_path").withColumn("_skip", skip)
    score = F.size(F.filter("resolved", lambda r: ~r["field"].eqNullSafe(F.col("_skip"))))
    cand = cand.withColumn("sheet_score", score)
    best = cand.groupBy(*files.columns).agg(
        F.max_by(F.struct(*columns, "sheet_score"), F.struct("sheet_score", -F.col("sheet_idx"))).alias("b"))
    pairs = F.transform("b.resolved", lambda r: F.struct(r["field"].alias("field"), r["col_idx"].alias("col_idx")))
    return best.select(*files.columns, "b.*", F.map_from_entries(pairs).alias("mapping"))


def canonical_cells(rows: DataFrame, mapping: DataFrame, fields=CANONICAL_FIELDS) -> DataFrame:
    """Data rows (below the header) of the chosen sheets, one cell per field.

    ``mapping`` has one row per chosen (file, dataset), see
    ``joins.join_small``.  Cells never leave their row."""
    from regfuse.operators.joins import join_small

    carried = [c for c in mapping.columns if c in ("dataset", "file_rank")]
    m = mapping.select(*SHEET_KEY, *carried, "header_row", "mapping")
    d = join_small(rows, m, SHEET_KEY).where(
        F.col("row_idx") > F.col("header_row")
    )
    cols = [F.col(c) for c in ("source_path", "source_sheet", "sheet_idx", *carried, "header_row", "row_idx", "date1904")]
    for f in fields:
        pos = F.try_element_at(F.col("mapping"), F.lit(f))
        cols.append(F.when(pos.isNotNull(), F.try_element_at(F.col("cells"), pos)).alias(f"c_{f}"))
    return d.select(*cols)
