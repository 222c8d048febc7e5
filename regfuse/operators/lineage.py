"""Which rows an indicator is based on: bitmaps of row ids per indicator cell.

``cell_bitmaps`` keeps, for every cell of the indicator matrix (a dimension and its value, or the total), the ids of its rows as
bitmaps of 32,768 ids each: a stored table that is far smaller than the rows and answers without reading them.  Cells are
combined with ``any_of`` and ``all_of`` (bitwise, bucket by bucket) and turned into ids, and into (file, sheet, row), with
``row_ids`` and ``rows_behind``.  A cell of a third of all rows is as many bitmaps as any other of its span, spread by bucket.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32_768  # ids of one bitmap


def cell_bitmaps(auth: DataFrame, dimensions: list[str], id_col: str = "project_row_id", missing: str = "SIN_DATO",
                 only: Column | None = None) -> DataFrame:
    """(dimension, valor, bucket, bitmap, n) of each dimension's values and of the total; ``only``: rows that count (for
    instance those with benefits).  Rows without an id are left out; a NULL value is ``missing``."""
    rows = auth.where(F.col(id_col).isNotNull())
    rows = rows.where(only) if only is not None else rows
    cells = [F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit(missing)).alias("valor")) for d in dimensions]
    cells.append(F.struct(F.lit("total").alias("dimension"), F.lit("total").alias("valor")))
    spread = rows.select(F.col(id_col).alias("_id"), F.explode(F.array(*cells)).alias("_c"))
    return spread.groupBy("_c.dimension", "_c.valor", F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bitmap")).withColumn("n", F.bitmap_count("bitmap"))


def _cells(bitmaps: DataFrame, cells: list[tuple[str, str]]) -> DataFrame:
    wanted = [(F.col("dimension") == d) & (F.col("valor") == v) for d, v in dict.fromkeys(cells)]
    return bitmaps.where(reduce(lambda a, b: a | b, wanted))


def any_of(bitmaps: DataFrame, cells: list[tuple[str, str]]) -> DataFrame:
    """(bucket, bitmap, n) of the rows that are in some of ``cells`` ((dimension, value) pairs)."""
    out = _cells(bitmaps, cells).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return out.withColumn("n", F.bitmap_count("bitmap"))


def all_of(bitmaps: DataFrame, cells: list[tuple[str, str]]) -> DataFrame:
    """(bucket, bitmap, n) of the rows that are in all of ``cells``; buckets without such a row are left out."""
    both = _cells(bitmaps, cells).groupBy("bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("_c"))
    both = both.where(F.col("_c") == len(set(cells))).drop("_c")  # a cell without the bucket has none of its rows
    return both.withColumn("n", F.bitmap_count("bitmap")).where(F.col("n") > 0)


def row_ids(bitmaps: DataFrame, id_col: str = "project_row_id") -> DataFrame:
    """A row for each id in the bitmaps, with their other columns: bytes that are 0 are passed over."""
    kept = [c for c in bitmaps.columns if c not in ("bucket", "bitmap", "n")]
    at = F.explode(F.sequence(F.lit(0), F.octet_length("bitmap") - 1)).alias("_byte")
    by_byte = bitmaps.select(*kept, "bucket", "bitmap", at)
    value = F.conv(F.hex(F.expr("substring(bitmap, _byte + 1, 1)")), 16, 10).cast("int")
    by_byte = by_byte.select(*kept, "bucket", "_byte", value.alias("_value")).where(F.col("_value") > 0)
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.getbit(F.col("_value").cast("bigint"), i) == 1)).alias("_bit")
    # bucket b holds the ids (b - 1) * BITS + 1 to b * BITS
    bits = by_byte.select(*kept, "bucket", "_byte", bit)
    return bits.select(*kept, ((F.col("bucket") - 1) * BITS + F.col("_byte") * 8 + F.col("_bit") + 1).alias(id_col))


def rows_behind(bitmaps: DataFrame, auth: DataFrame, id_col: str = "project_row_id",
                columns=("source_file", "source_sheet", "source_row")) -> DataFrame:
    """The rows of ``auth`` behind each cell, by their provenance."""
    return row_ids(bitmaps, id_col).join(auth.select(id_col, *columns), id_col)
