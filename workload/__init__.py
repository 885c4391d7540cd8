"""Registered queries, each next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, with their SQL where there is one.

    A query without SQL has ``columns``, its result's names and types, and ``holds``, which must be true of every row; a
    result without rows may be right.
    """

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}
        self.promises: dict[str, tuple[str, Callable[[Row], bool]]] = {}

    def query(self, sql: str | None = None, columns: str | None = None, holds: Callable[[Row], bool] = bool):
        def register(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            if columns is not None:
                self.promises[function.__name__] = (columns, holds)
            return function

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, on all cores.

    A given table of one file with one row group comes as one partition, and work that is heavy per row would run in one
    task; only such small tables are dealt out. A large table has splits enough and is read as it is.
    """
    rows = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
