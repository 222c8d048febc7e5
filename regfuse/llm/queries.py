"""The numbered operators over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.llm import (
    decontaminate,
    hard_negatives,
    language,
    lexical_search,
    licenses,
    line_dedup,
    main_text,
    mixing,
    near_dedup,
    neighbours,
    quality,
    token_store,
    web_archives,
)
from regfuse.llm.common import table
from regfuse.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 50; the index holds every row."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.where("vec_id % 50 = 0"), neighbours.build_index(vectors))


@query
def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_documents(table(spark, sf_dir, "documents"), tokenizer_json())


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no address: their source is the host and their language its section."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, table(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; labels of ids divisible by 7 are moved on by one first."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.scaled(vectors.withColumn("label", moved))
    return hard_negatives.mine(rows, rows.where("id % 100 = 0"))


@query
def op12_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archives.round_trip(table(spark, sf_dir, "pages"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def tokenizer_json() -> str:
    """The public tokenizer's definition, read where the driver runs; tasks get the text."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()
