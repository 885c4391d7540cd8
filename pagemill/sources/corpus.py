"""Parquet tables of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_corpus(pages: DataFrame, path: str, partition_by: str | None = "content_type") -> None:
    """Overwrite a Parquet table; every task writes its own rows, so a large content type is never gathered."""
    writer = pages.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
