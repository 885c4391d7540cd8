"""Exact duplicates through an extendible-hash index on shared files, in DataFrame operations only.

The directory covers the leading bits of a 64-bit hash. It starts with one bucket and doubles while a bucket holds more
rows than a task should own; a bucket is then a range of hashes with a depth of its own. Owner tasks group a range's rows
by hash and whole text, so colliding hashes are told apart by their bytes and chained.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.session import new_table_path, written

#: The directory never has more than 2^BITS entries, whatever the input.
BITS = 16


def grown_directory(counts: dict[int, int], bucket_rows: int, bits: int = BITS) -> list[tuple[int, int, int]]:
    """``(entry, bucket, local depth)`` for every entry, from rows by leading ``bits``.

    Doubling: a bucket over ``bucket_rows`` splits at its next bit, at most ``bits`` deep; what is fuller still, such as
    the copies of one text, stays one bucket. A bucket's number is its first entry.
    """
    sums = [0]
    for entry in range(1 << bits):
        sums.append(sums[-1] + counts.get(entry, 0))
    buckets, depth, open_buckets = [], 0, [0]
    while open_buckets:
        width = 1 << (bits - depth)
        full = [b for b in open_buckets if sums[b + width] - sums[b] > bucket_rows and depth < bits]
        buckets += [(b, depth) for b in set(open_buckets) - set(full)]
        open_buckets = [half for b in full for half in (b, b + width // 2)]
        depth += 1
    return [(entry, b, d) for b, d in sorted(buckets) for entry in range(b, b + (1 << (bits - d)))]


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = 1 << 16) -> DataFrame:
    """One row per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``bucket``, ``chain``.

    Texts are equal when their bytes are; null counts as empty. The row with the largest key stays. Rows that repeat key
    and text are one document and share ``kept``; a null key is smaller than any other. ``chain`` numbers the different
    texts of one hash. Only keys and hashes are joined back; texts are shuffled once, copies merged before.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), body.alias("body"), F.xxhash64(body).alias("hash"))
    rows = rows.withColumn("entry", F.shiftrightunsigned("hash", 64 - BITS).cast("int"))
    counts = {r[0]: r[1] for r in rows.groupBy("entry").count().collect()}  # at most 2^BITS rows
    directory = spark.createDataFrame(pd.DataFrame(grown_directory(counts, max(bucket_rows, sum(counts.values()) >> 12)), columns=["entry", "bucket", "depth"]), "entry int, bucket int, depth int")
    path = new_table_path(spark, "directory")
    directory.coalesce(1).write.parquet(path)
    owned = rows.join(F.broadcast(spark.read.schema(directory.schema).parquet(path)), "entry")
    texts = owned.groupBy("bucket", "hash", "body").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    digest = F.sha2(F.col("body"), 256).alias("text_sha256")
    index = texts.select("bucket", "hash", digest, "keep_id", "group_size")
    chain = Window.partitionBy("bucket", "hash").orderBy("text_sha256")
    index = written(index.withColumn("chain", F.row_number().over(chain) - 1), "hash-index")
    found = rows.select("id", "hash", digest).join(index, ["hash", "text_sha256"])
    return found.select(F.col("id").alias(key), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain")
