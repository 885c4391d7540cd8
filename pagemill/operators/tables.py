"""Looking at a table: row sample, profile, keyed lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BROADCAST_KEYS = 100_000


def random_rows(table: DataFrame, key: str, n: int = 1, seed: int = 42) -> DataFrame:
    """The rows of ``n`` keys in a repeatable random order of the keys.

    The draw reads only the key column. A key that repeats counts once and brings all its rows. The drawn keys meet the
    table in a semi-join; a small draw is broadcast, and the rows of the table stay where they are.
    """
    order = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    drawn = table.select(key).distinct().orderBy(order, key).limit(n)
    return table.join(F.broadcast(drawn) if n <= BROADCAST_KEYS else drawn, key, "left_semi")


def profile(table: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, distinct (estimate), smallest and largest value as text."""
    types = dict(table.dtypes)

    def stats(name: str) -> Column:
        column = F.col(name)
        plain = not types[name].startswith(("array", "map", "struct"))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(types[name]).alias("dtype"),
            F.count("*").alias("n_rows"),
            (F.count("*") - F.count(column)).alias("n_null"),
            (F.approx_count_distinct(column) if plain else F.lit(None).cast("bigint")).alias("n_distinct_estimate"),
            (F.min(column).cast("string") if plain else F.lit(None).cast("string")).alias("min_value"),
            (F.max(column).cast("string") if plain else F.lit(None).cast("string")).alias("max_value"),
        )

    return table.agg(F.array(*[stats(c) for c in table.columns]).alias("stats")).select(F.inline("stats"))


def row_by_key(table: DataFrame, key: str, value) -> DataFrame:
    """The rows with one key value; the comparison is pushed to the scan."""
    return table.filter(F.col(key) == F.lit(value))
