"""Parquet scans: columns pruned, splits left to the session's file settings
(``spark.sql.files.maxPartitionBytes``, ``openCostInBytes``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
