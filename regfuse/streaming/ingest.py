"""Incremental ingestion of workbooks that keep landing in a folder.

The file stream source lists the folder, hands every *new* workbook to the
same per-file decoder the batch job uses (``mapInArrow``), and appends the
decoded rows to a parquet table.  The stream keeps its progress in a
checkpoint location on shared storage, so a restarted job (or a lost
executor) neither skips nor re-decodes a workbook.  The batch linkage then
reads the accumulated rows (``link_decoded``) instead of decoding every
workbook again.

The stream is stateless (no aggregation), so it needs no watermark; run it
continuously or with ``availableNow`` as a scheduled catch-up.

The file source hands out each *path* once: a workbook that is rewritten in
place is not read again.  Where that happens use ``refresh`` (one run) or
``start_refresh`` (a run at every trigger) instead: they keep a state of
(path, time, length, content hash), decode what is new or has other content,
and publish the next state by one manifest, so a newer file's rows replace
the older ones at once and a run that ends early changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regfuse.operators import replacement
from regfuse.session import materialize, remove
from regfuse.sources import sinks
from regfuse.sources import workbook as W

# the binaryFile source's fixed schema (a stream must declare it)
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def decoded_stream(spark: SparkSession, input_dir: str, output_dir: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of decoded rows (``workbook.DECODED_SCHEMA``) plus
    the file's dataset classes, for every selected workbook that appears."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = W.classify_files(reader.load(input_dir), output_dir).where(F.col("status") == "selected")
    return files.select("path", "content").mapInArrow(W.decode_batches, W.DECODED_SCHEMA)


def start_ingest(spark: SparkSession, input_dir: str, table_dir: str, checkpoint_location: str,
                 output_dir: str | None = None, available_now: bool = False,
                 processing_time: str = "1 minute") -> StreamingQuery:
    """Append decoded rows of new workbooks to the parquet table ``table_dir``."""
    w = (
        decoded_stream(spark, input_dir, output_dir)
        .writeStream.format("parquet")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def _raw(spark: SparkSession, input_dir: str, output_dir: str | None, files: DataFrame) -> DataFrame:
    """(path, content) of ``files``.  The span of their times is pushed into the source, so that other files' contents are
    not read unless their time lies within it."""
    first, last = files.agg(F.min("modificationTime"), F.max("modificationTime")).first()
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(input_dir)
    return every.where(F.col("modificationTime").between(first, last)).join(files.select("path"), "path", "left_semi").select("path", "content")


def _state(spark: SparkSession, table_dir: str) -> DataFrame:
    try:
        return sinks.read_published(spark, table_dir, "files")
    except FileNotFoundError:  # nothing was published yet
        return spark.createDataFrame([], replacement.STATE)


def refresh(spark: SparkSession, input_dir: str, table_dir: str, output_dir: str | None = None) -> dict[str, int]:
    """Bring the table at ``table_dir`` up to the folder: decode workbooks that are new or have other content, forget those
    that are gone.  Returns the number of files per change (``new``, ``replaced``, ``touched``, ``removed``).

    Nothing changes for readers until the next state is published.  A rewrite that keeps both time and length is not seen;
    a file that is altered while the run reads it is met again by the next one, since the state holds the listed time.  One
    run at a time."""
    state, run = _state(spark, table_dir), f"r{uuid.uuid4().hex}"
    listing = W.inventory(spark, input_dir, output_dir).where(F.col("status") == "selected")
    changes = materialize(replacement.changed_files(listing, state))
    made = [changes]
    try:
        to_read = changes.where("change <> 'removed'")
        if changes.isEmpty():
            return {}
        if to_read.isEmpty():
            hashed = spark.createDataFrame([], "path string, content_hash string")
        else:
            hashed = materialize(_raw(spark, input_dir, output_dir, to_read).select("path", F.sha2("content", 256).alias("content_hash")))
            made.append(hashed)
        done = materialize(replacement.outcomes(state, changes, hashed, run))
        made.append(done)
        fresh = done.where(F.col("rows_at") == run)
        if not fresh.isEmpty():
            decoded = _raw(spark, input_dir, output_dir, fresh).mapInArrow(W.decode_batches, W.DECODED_SCHEMA)
            decoded.write.mode("error").parquet(f"{table_dir.rstrip('/')}/rows/rows_at={run}")
        sinks.publish({"files": replacement.next_state(state, done)}, table_dir)
        return {r["change"]: r["count"] for r in done.groupBy("change").count().collect()}  # four kinds
    finally:
        for df in made:
            remove(df)


def start_refresh(spark: SparkSession, input_dir: str, table_dir: str, checkpoint_location: str, output_dir: str | None = None,
                  processing_time: str = "1 minute") -> StreamingQuery:
    """``refresh`` at every trigger; the rate source is only the clock."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda batch, _: refresh(batch.sparkSession, input_dir, table_dir, output_dir) and None)
        .option("checkpointLocation", checkpoint_location).trigger(processingTime=processing_time).start()
    )


def refreshed_rows(spark: SparkSession, table_dir: str) -> DataFrame:
    """Decoded rows (``workbook.DECODED_SCHEMA``) of the present content of every workbook."""
    schema = T.StructType([*W.DECODED_SCHEMA.fields, T.StructField("rows_at", T.StringType())])
    state = _state(spark, table_dir)
    if state.isEmpty():
        return spark.createDataFrame([], W.DECODED_SCHEMA)
    rows = spark.read.schema(schema).parquet(f"{table_dir.rstrip('/')}/rows")
    return replacement.current_rows(rows, state).select(*W.DECODED_SCHEMA.fieldNames())


def link_refreshed(spark: SparkSession, table_dir: str, input_dir: str, output_dir: str | None = None):
    """Registers and authoritative table from ``refreshed_rows``."""
    return _link(spark, refreshed_rows(spark, table_dir), input_dir, output_dir)


def link_decoded(spark: SparkSession, table_dir: str, input_dir: str, output_dir: str | None = None):
    """Registers and authoritative table from the accumulated decoded rows."""
    return _link(spark, spark.read.parquet(table_dir), input_dir, output_dir)


def _link(spark: SparkSession, decoded: DataFrame, input_dir: str, output_dir: str | None):
    from regfuse.operators import consolidate
    from regfuse.plans.pipeline import registers_from_rows

    rows = W.read_rows(decoded)
    files = W.selected_files(W.inventory(spark, input_dir, output_dir))
    files = files.join(decoded.select("source_path").distinct(), "source_path", "left_semi")
    regs, inf = registers_from_rows(rows, files)
    return regs, consolidate.authoritative(regs["presentados"], regs["recomendados"])
