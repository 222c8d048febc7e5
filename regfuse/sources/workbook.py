"""Workbook discovery and decoding as Spark scans.

* ``inventory``  - recursive file listing through the ``binaryFile`` source
  with the ``content`` column pruned (only path, size, mtime are read), then
  classification with column expressions: workbook extension (any case),
  Excel lock files, the output folder, and the dataset each file name
  belongs to (a file may belong to both).
* ``read_rows``  - the same listing with ``content``, decoded per file inside
  ``mapInArrow``: every task decodes whole workbooks (a workbook is not
  splittable) and streams out Arrow batches of rows.  Files are read by
  Spark's file source, so any Hadoop-compatible storage works.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regfuse.functions import text as tx
from regfuse.functions.constants import DATASET_PATTERNS
from regfuse.operators.headers import ROWS_SCHEMA

WORKBOOK_EXT = r"(?i)\.xls[xm]?$"
DECODED_EXT = r"(?i)\.xls[xm]$"

DECODED_SCHEMA = T.StructType(list(ROWS_SCHEMA.fields) + [T.StructField("decode_error", T.StringType())])


def base_name(path) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1)


def _listing(spark: SparkSession, input_dir: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(input_dir)


def classify_files(df: DataFrame, output_dir: str | None, patterns=DATASET_PATTERNS) -> DataFrame:
    name = base_name("path")
    norm = tx.normalize_name(name)
    in_output = F.lit(False) if not output_dir else F.col("path").contains(output_dir)
    datasets = F.filter(
        F.array(*[F.when(norm.contains(p), F.lit(ds)) for ds, p in patterns.items()]),
        lambda x: x.isNotNull(),
    )
    return df.withColumns(
        {
            "file_name": name,
            "is_workbook": name.rlike(WORKBOOK_EXT),
            "is_lock_file": name.startswith("~$"),
            "in_output_dir": in_output,
            "datasets": datasets,
        }
    ).withColumn(
        "status",
        F.when(~F.col("is_workbook"), F.lit("not_a_workbook"))
        .when(F.col("is_lock_file"), F.lit("lock_file"))
        .when(F.col("in_output_dir"), F.lit("output_dir"))
        .when(F.size("datasets") == 0, F.lit("unclassified"))
        .when(~name.rlike(DECODED_EXT), F.lit("unsupported_format"))
        .otherwise(F.lit("selected")),
    )


def inventory(spark: SparkSession, input_dir: str, output_dir: str | None = None, patterns=DATASET_PATTERNS) -> DataFrame:
    """One row per file under ``input_dir``: path parts, size, mtime, datasets, status."""
    files = _listing(spark, input_dir).select("path", "modificationTime", "length")
    out = classify_files(files, output_dir, patterns)
    return out.withColumn("dir_parts", F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1))


def selected_files(inv: DataFrame) -> DataFrame:
    """(source_path, dataset, file_rank): files to load; ``file_rank`` grows
    with the path inside each dataset (the order rows are bound in).

    Ranks come from the distributed dense-id operator (range partitioning on
    (dataset, path)), not from a window holding every file of a dataset."""
    from regfuse.operators.rowid import dense_row_ids

    sel = inv.where(F.col("status") == "selected").select(
        F.col("path").alias("source_path"), F.explode("datasets").alias("dataset")
    )
    return dense_row_ids(sel, ["dataset", "source_path"], "file_rank")


def require_datasets(files: DataFrame, patterns=DATASET_PATTERNS) -> None:
    """Fail unless every dataset has at least one file."""
    counts = {r["dataset"]: r["n"] for r in files.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).collect()}
    missing = [d for d in patterns if not counts.get(d)]
    if missing:
        pats = ", ".join(f"'{p}'" for p in patterns.values())
        raise FileNotFoundError(
            f"no workbook found for {', '.join(missing)}; expected file names containing {pats}"
        )


def _cell_type():
    return pa.struct(
        [("cell_type", pa.string()), ("text", pa.string()), ("num", pa.float64()), ("ts", pa.timestamp("us"))]
    )


def _arrow_schema() -> pa.Schema:
    return pa.schema(
        [
            ("source_path", pa.string()),
            ("source_sheet", pa.string()),
            ("sheet_idx", pa.int32()),
            ("row_idx", pa.int32()),
            ("cells", pa.map_(pa.int32(), _cell_type())),
            ("date1904", pa.bool_()),
            ("decode_error", pa.string()),
        ]
    )


def decode_batches(batches, max_rows: int = 4096):
    """mapInArrow body: (path, content) batches -> decoded row batches.

    A file's batches go out once it is decoded to its end; a file that fails
    anywhere gives one error row and no data."""
    from regfuse.sources.xlsx import decode_workbook

    schema = _arrow_schema()

    def batch_of(rows: list[dict]):
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            whole, rows = [], []
            try:
                for sheet, sheet_idx, row_idx, cells, date1904 in decode_workbook(content.as_py()):
                    typed = [(k, {"cell_type": t, "text": s, "num": n, "ts": ts}) for k, (t, s, n, ts) in cells.items()]
                    rows.append({"source_path": path, "source_sheet": sheet, "sheet_idx": sheet_idx, "row_idx": row_idx,
                                 "cells": typed, "date1904": date1904})
                    if len(rows) >= max_rows:
                        whole.append(batch_of(rows))
                        rows = []
                whole.append(batch_of(rows))
            except Exception as e:  # whatever is wrong with one file is that file's entry in the ledger
                whole = [batch_of([{"source_path": path, "decode_error": f"{type(e).__name__}: {e}"}])]
            yield from (x for x in whole if x.num_rows)


def read_decoded(spark: SparkSession, input_dir: str, output_dir: str | None = None, patterns=DATASET_PATTERNS) -> DataFrame:
    """Decoded rows of every selected workbook plus one error row per file
    that could not be decoded (``decode_error`` set, no cells)."""
    raw = classify_files(_listing(spark, input_dir), output_dir, patterns).where(F.col("status") == "selected")
    return raw.select("path", "content").mapInArrow(decode_batches, DECODED_SCHEMA)


def read_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("decode_error").isNull()).drop("decode_error")


def decode_errors(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("decode_error").isNotNull()).select("source_path", "decode_error")

