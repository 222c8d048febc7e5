"""Helpers shared by the operators: written intermediates, word hashes, shingles."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import regfuse
from regfuse.session import checkpoint_dir, materialize

_MIX1, _MIX2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give Python workers this package (as ``--py-files`` does), once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped[context.applicationId] = folder = tempfile.TemporaryDirectory()  # goes when the driver ends
    top, name = Path(regfuse.__file__).parent, os.path.join(folder.name, "regfuse_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    context.addPyFile(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder: computed once, cut from its lineage, and a plain
    table for later joins (so that adaptive execution can split hot keys)."""
    checkpoint_dir(df.sparkSession)
    return materialize(df)


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes from now on: some rows are very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def sampled(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """All of ``df``, or about ``rows`` of its rows: those whose keys' hash falls below the share that gives as many.
    The same rows on every run, and no sort or gathering to find them."""
    n = df.count()
    share = (F.xxhash64(*keys, F.lit("sample")).cast("double") + 2.0**63) / 2.0**64
    return df if n <= rows else df.where(share < rows / n)


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered; emptied when it holds ``limit`` words, so memory is bounded."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text with A-Z lower-cased (bytes methods know only ASCII)."""
    return text.lower().split()


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for every run of ``n`` consecutive word hashes, in text order."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(count, n, np.uint64)
    for j in range(n):
        acc = mix64(acc * _BASE + words[j : j + count])
    return acc


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingles; fewer words count as one shingle, no words as none."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(n, len(words))))


def texts_of(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column, without decoding."""
    column = column if isinstance(column, pa.Array) else column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()
