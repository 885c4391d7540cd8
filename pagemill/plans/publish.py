"""The published corpus table: archives to Parquet with page fields and text features."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.pages import page_rows, with_html_fields
from pagemill.plans.features import at_rest, fit_features, transform_features
from pagemill.sources.corpus import read_corpus, write_corpus

COLUMNS = [
    "url",
    "date",
    "content",
    "content_type",
    "title",
    "title_content",
    "body_content",
    "content_embedded",
    "content_idf",
]


def publish_corpus(
    records: DataFrame, target: str, partitions: int | None = None, strict: bool = False
) -> tuple[DataFrame, PipelineModel]:
    """Write ``target/decoded``, ``target/broken``, ``target/model`` and ``target/corpus``; returns the corpus and the model.

    ``records`` are archive rows; read them with ``record_types=["response"]``, so that others are skipped unread. The
    archives are decoded once, into ``decoded``: archive files are uneven and cannot be split, the Parquet written from
    them can. Archives that could not be read to their end are listed in ``broken`` (``broken_archives``); what came
    before the break is published. Fitting reads only ``content`` and the last step runs without a shuffle.
    """
    spark = records.sparkSession
    decoded = page_rows(records, strict, keep=["filename", "error"])
    write_corpus(decoded.withColumn("is_broken", F.col("error").isNotNull().cast("int")), f"{target}/decoded", partition_by="is_broken")
    pages = read_corpus(spark, f"{target}/decoded")
    write_corpus(pages.filter("is_broken = 1").select("filename", "error"), f"{target}/broken", partition_by=None)
    pages = pages.filter("is_broken = 0").drop("is_broken", "filename", "error")
    model = fit_features(pages, partitions=partitions)
    model.write().overwrite().save(f"{target}/model")
    published = at_rest(transform_features(model, with_html_fields(pages))).select(*COLUMNS)
    write_corpus(published, f"{target}/corpus", partition_by="content_type")
    return read_corpus(spark, f"{target}/corpus"), model


def broken_archives(spark: SparkSession, target: str) -> DataFrame:
    """``(filename, error)`` of the archives that ``publish_corpus`` could not finish."""
    return read_corpus(spark, f"{target}/broken")
