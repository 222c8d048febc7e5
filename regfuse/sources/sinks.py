"""Sinks: CSV (header, NULL as empty field) or parquet, with a row counter.

The row count is collected with ``DataFrame.observe`` during the write
itself - no second job over the output.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_ready(df: DataFrame) -> DataFrame:
    """Booleans as ``TRUE``/``FALSE`` and doubles in plain notation, so the
    CSV text does not depend on Spark's number printing."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = F.upper(c.cast("string"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            from regfuse.functions.text import num_to_text

            c = num_to_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> int:
    """Write ``df`` to ``path``; returns the number of rows written."""
    obs = Observation(f"rows_{abs(hash(path))}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "csv":
        (
            csv_ready(observed).write.mode(mode)
            .option("header", True)
            .option("nullValue", "")
            .option("emptyValue", "")
            .option("escape", '"')  # a quote inside a field is doubled
            .csv(path)
        )
    elif fmt == "parquet":
        observed.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return int(obs.get["rows"])


def read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A table that ``write`` wrote, with its types."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def file_place():
    """Where a row of a written parquet table stands: file (they are numbered in the table's order) and row in the file.
    For ``select`` on a plain scan: two columns, ``_file`` and ``_row``."""
    return F.expr("inline(array(struct(_metadata.file_name AS _file, _metadata.row_index AS _row)))")


def write_all(outputs: dict[str, DataFrame], output_dir: str, fmt: str = "csv") -> dict[str, int]:
    base = output_dir.rstrip("/")
    return {name: write(df, f"{base}/{name}", fmt) for name, df in outputs.items()}


# ---- one publication of several tables ---------------------------------------
# folder/_data/<id>/<table>     the tables of one publication, under a new name each time
# folder/_manifests/<n>.json    what the publication holds; creating it is the commit, the highest number counts


def _checksum(df: DataFrame) -> list:
    """Aggregates over all rows, in any order: their number, and the sum of their hashes."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string").alias("checksum")]


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_manifests")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, folder: str) -> list[int]:
    store, path = _store(spark, folder)
    if not store.exists(path):
        return []
    names = [f.getPath().getName() for f in store.listStatus(path)]
    return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json"))


def publish(outputs: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, int]:
    """Write all tables, then make them the current publication in one step; returns rows per table.

    Until the manifest exists readers see the former publication, whole: a run that ends early leaves files that no
    manifest names.  A manifest is created without overwriting, so of two runs at once the later one takes the next number."""
    spark = next(iter(outputs.values())).sparkSession
    place = f"_data/{uuid.uuid4().hex}"
    tables = {}
    for name, df in outputs.items():
        obs = Observation(f"published_{name}")
        write(df.observe(obs, *_checksum(df)), f"{folder.rstrip('/')}/{place}/{name}", fmt, mode="error")
        tables[name] = {"path": f"{place}/{name}", "format": fmt, "schema": df.schema.jsonValue(), **obs.get}
    store, path = _store(spark, folder)
    store.mkdirs(path)
    text = json.dumps({"tables": tables}).encode()
    hadoop = spark._jvm.org.apache.hadoop.fs
    # written under another name first: a manifest is never seen half written
    draft = hadoop.Path(path, f"{uuid.uuid4().hex}.draft")
    out = store.create(draft, False)
    out.write(bytearray(text))
    out.close()
    number = (_versions(spark, folder) or [0])[-1] + 1
    while store.exists(hadoop.Path(path, f"{number}.json")) or not store.rename(draft, hadoop.Path(path, f"{number}.json")):
        number += 1
    return {name: t["rows"] for name, t in tables.items()}


def manifest(spark: SparkSession, folder: str) -> dict:
    """The current publication: {table: path, format, schema, rows, checksum}."""
    numbers = _versions(spark, folder)
    if not numbers:
        raise FileNotFoundError(f"nothing is published in {folder}")
    file = f"{folder.rstrip('/')}/_manifests/{numbers[-1]}.json"
    return json.loads(spark.read.text(file, wholetext=True).first()[0])["tables"]


def read_published(spark: SparkSession, folder: str, name: str, verify: bool = False) -> DataFrame:
    """A table of the current publication.  ``verify``: read it once to compare rows and checksum with the manifest's."""
    t = manifest(spark, folder)[name]
    df = read(spark, f"{folder.rstrip('/')}/{t['path']}", T.StructType.fromJson(t["schema"]), t["format"])
    if verify:
        found = df.agg(*_checksum(df)).first()
        if (found["rows"], found["checksum"]) != (t["rows"], t["checksum"]):
            raise ValueError(f"{name} is not what was published: {found['rows']} rows instead of {t['rows']}, or other values")
    return df
