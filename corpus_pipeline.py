"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

quality classifier -> near-duplicates -> benchmark decontamination -> mixing -> token ids.  Every stage works on all rows
that the one before kept, and returns the columns of ``documents`` (the last one returns a digest of the stored ids).
Learned weights, sketches, alignment and a tokenizer have no SQL form: ``ORACLE_SQL`` is None and the stages are tested
against brute-force versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.llm import decontaminate, mixing, near_dedup, quality, token_store
from regfuse.llm.common import table
from regfuse.llm.queries import tokenizer_json
from regfuse.session import checkpoint_dir


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (null among them) is in ``ids``."""
    ids = ids.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, docs.doc_id.eqNullSafe(ids.kept_id), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  A doc_id stays if one of its rows is kept; none with an empty table."""
    scored = quality.score(docs, table(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang"))
    return _only(docs, scored.where("kept"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id."""
    return _only(docs, near_dedup.near_duplicates(docs).where("kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, verbatim or edited, go.  Rows without a doc_id stay."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("found_id")).distinct()
    return docs.join(found, docs.doc_id == found.found_id, "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, none to three."""
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, written to a store and read back: doc_id, start, n_tokens, ids_crc32."""
    return token_store.encode_documents(docs, tokenizer_json())


STAGES = [
    ("quality classifier", quality_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
    ("token output", token_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{k}")
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
