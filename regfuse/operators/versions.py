"""Versions of one form: which file follows which, and what changed between them.

Files of a form share a *family*: their folder and their normalised base name without marks of a version (numbers, dates,
``v2``, ``final``, ``copia``).  ``version_chain`` orders a family by modification time; a file with the content of the one
before it is not a version.  ``version_diff`` compares the rows of consecutive versions by key: all pairs at once, in one
aggregation whose partial counts are made before rows are exchanged, so a key that repeats very often is a single row by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regfuse.functions import text as tx

VERSION_MARKS = r"(^|_)(v(er|ersion)?_?[0-9]+|[0-9]+|final|definitivo|copia|corregido|nuevo|rev(ision)?)(?=_|$)"


def family(path) -> Column:
    """Folder and normalised base name without extension and version marks; a name of marks only keeps them."""
    p = F.col(path) if isinstance(path, str) else path
    name = tx.normalize_name(F.regexp_replace(F.substring_index(p, "/", -1), r"\.[A-Za-z]+$", ""))
    bare = F.btrim(F.regexp_replace(name, VERSION_MARKS, ""), F.lit("_"))
    folder = F.when(p.contains("/"), F.regexp_replace(p, "/[^/]*$", "")).otherwise(F.lit(""))
    return F.concat(folder, F.lit("/"), F.when(bare != "", bare).otherwise(name))


def version_chain(files: DataFrame, path: str = "path", changed: str = "modificationTime", content: str = "content_hash") -> DataFrame:
    """family, path, version (from 1), previous_path (NULL for the first): a row per version, in order of time, then path.

    A file whose content equals that of the file before it in time is left out; a NULL content is taken as new."""
    by_time = Window.partitionBy("family").orderBy(F.col(changed).asc_nulls_first(), path)  # files, not rows
    f = files.withColumn("family", family(path)).withColumn("_before", F.lag(content).over(by_time))
    f = f.where(F.col("_before").isNull() | F.col(content).isNull() | (F.col("_before") != F.col(content)))
    return f.select("family", path, F.row_number().over(by_time).alias("version"), F.lag(path).over(by_time).alias("previous_path"))


def version_diff(rows: DataFrame, chain: DataFrame, key: list[str], values: list[str], path: str = "path") -> DataFrame:
    """(family, version, key columns, change) for every key that differs between a version and the one before it: ``added``,
    ``removed`` or ``changed``; keys with the same rows in both are left out.

    ``rows``: the rows of all files, told apart by ``path``; ``values``: columns that count as content.  A key may repeat: its
    rows are compared as a whole, in any order.  NULLs are values like any other.  First versions have no differences."""
    digest = F.unhex(F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256))
    r = rows.select(F.col(path).alias("_path"), F.struct(*key).alias("_key"), digest.alias("_digest"))
    later = chain.where(F.col("previous_path").isNotNull())
    sides = later.select("family", "version", F.col(path).alias("_path"), F.lit(1).alias("_new")).unionByName(
        later.select("family", "version", F.col("previous_path").alias("_path"), F.lit(0).alias("_new")))
    new = F.col("_new")
    # a row or two per file, which a listing holds anyway: rows are not exchanged by file, where one file would be one task
    counted = r.join(F.broadcast(sides), "_path").groupBy("family", "version", "_key", "_digest").agg(
        F.sum(new).alias("_n"), F.sum(1 - new).alias("_o"))
    by_key = counted.groupBy("family", "version", "_key").agg(
        F.sum("_n").alias("_n"), F.sum("_o").alias("_o"), F.max(F.col("_n") != F.col("_o")).alias("_differs"))
    change = F.when(F.col("_o") == 0, "added").when(F.col("_n") == 0, "removed").otherwise("changed")
    return by_key.where("_differs").select("family", "version", "_key.*", change.alias("change"))
