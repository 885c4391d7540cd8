"""JSON lines with bad lines kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt"


def parse_json_lines(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Add the fields of ``schema`` parsed from ``column``; a line that is no JSON object fills ``_corrupt``."""
    fields = StructType.fromDDL(schema)
    declared = fields.add(CORRUPT, StringType())
    text = F.col(column)
    parsed = F.from_json(text, declared, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    staged = lines.withColumn("_parsed", parsed)
    is_object = text.rlike(r"^\s*\{") & F.col(f"_parsed.{CORRUPT}").isNull() & F.col("_parsed").isNotNull()
    return staged.select(
        *lines.columns,
        *[F.when(is_object, F.col(f"_parsed.{f.name}")).alias(f.name) for f in fields if f.name != CORRUPT],
        F.when(~F.coalesce(is_object, F.lit(False)), F.coalesce(text, F.lit(""))).alias(CORRUPT),
    )


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of text files as rows of ``schema`` plus ``_corrupt``."""
    return parse_json_lines(spark.read.text(path), "value", schema).drop("value")


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull())


def count_bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.agg(F.count("*").alias("n_lines"), F.count(CORRUPT).alias("n_bad"))
