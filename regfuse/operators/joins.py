"""Joining data rows to small per-file / per-sheet tables.

Every row of a workbook carries the same (path, sheet) key.  The join is a
plain equi-join: adaptive execution measures the small side and broadcasts it
while it is below the session's threshold; beyond it, both sides are shuffled
and a workbook that holds a large part of all rows is split over many tasks
(the small side has one row per key, so a split costs one more read of it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``small`` has at most one row per key."""
    return big.join(small, on, how)


def evaluated_once(df: DataFrame, costly: list[str], carried: list[str]) -> DataFrame:
    """``carried`` and ``costly`` columns, the latter as plain attributes: filters and projections above read their
    values and are not given their expressions again (they pass through a one-row generator)."""
    return df.select(*carried, F.inline(F.array(F.struct(*costly))))
