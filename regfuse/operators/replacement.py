"""Files that are rewritten in place: which ones changed, and which rows are current.

A *state* has one row per file: ``path, modificationTime, length, content_hash, rows_at``; ``rows_at`` names the run that
decoded the file's present content.  ``changed_files`` compares a new listing with the state, ``next_state`` replaces the
entries of the files that were read, and ``current_rows`` keeps, of all rows ever decoded, those their file's entry names.
Rows are never rewritten: a newer run's rows replace the older ones by the change of one entry.  All three are equi-joins by
path with one row a file on one side at least.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "path string, modificationTime timestamp, length bigint, content_hash string, rows_at string"
_SEEN = ["modificationTime", "length"]


def changed_files(listing: DataFrame, state: DataFrame) -> DataFrame:
    """(path, modificationTime, length, change) of the files that are ``new``, ``rewritten`` (another time or length than the
    state has) or ``removed`` (no longer listed; with the state's time and length).  A NULL time or length is a value."""
    now = listing.select("path", *_SEEN, F.lit(True).alias("_now"))
    old = state.select("path", *[F.col(c).alias(f"_{c}") for c in _SEEN], F.lit(True).alias("_old"))
    same = F.lit(True)
    for c in _SEEN:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_now").isNull(), "removed").when(~same, "rewritten")
    both = now.join(old, "path", "full").withColumn("change", change).where("change is not null")
    return both.select("path", *[F.when(F.col("_now").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in _SEEN], "change")


def outcomes(state: DataFrame, changes: DataFrame, hashed: DataFrame, rows_at: str) -> DataFrame:
    """``changes`` with ``content_hash``, ``rows_at`` and the final change: ``new``, ``replaced`` (other content), ``touched``
    (rewritten with equal content: its rows stay) or ``removed``.  ``hashed``: (path, content_hash) of the files that could be
    read; a changed file that is not among them is left out, so the next run meets it again."""
    old = state.select("path", F.col("content_hash").alias("_hash"), F.col("rows_at").alias("_rows"))
    read = changes.join(hashed.select("path", "content_hash"), "path", "left").join(old, "path", "left")
    read = read.where("change = 'removed' or content_hash is not null")
    touched = (F.col("change") == "rewritten") & F.col("content_hash").eqNullSafe(F.col("_hash"))
    final = F.when(touched, "touched").when(F.col("change") == "rewritten", "replaced").otherwise(F.col("change"))
    kept = F.when(touched, F.col("_rows")).when(F.col("change") != "removed", F.lit(rows_at))
    return read.select("path", *_SEEN, "content_hash", kept.alias("rows_at"), final.alias("change"))


def next_state(state: DataFrame, done: DataFrame) -> DataFrame:
    """The state after a run with these ``outcomes``."""
    stays = state.join(done.select("path"), "path", "left_anti")
    return stays.unionByName(done.where("change <> 'removed'").drop("change"))


def current_rows(rows: DataFrame, state: DataFrame, path: str = "source_path") -> DataFrame:
    """Of all decoded rows (with ``rows_at``) those of each file's present content."""
    entries = state.select(F.col("path").alias(path), "rows_at")
    return rows.join(entries, [path, "rows_at"], "left_semi")
