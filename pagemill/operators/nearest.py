"""Vector search: one query, a batch of queries, all pairs.

Scores are cosine similarities rounded to six digits, so equal scores are ordered by id everywhere.
No plan holds a pair table: tasks score blocks with numpy and pass on only the ``k`` best per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.functions.vectors import cosine, hamming, sign_words
from pagemill.operators.topk import DIGITS, BestScores, query_chunks, rank_scores, score_slices
from pagemill.session import broadcast_if_small, written

BROADCAST_BYTES = 64 << 20
#: All pairs are dealt out so that a task has about so many of them.
TASK_PAIRS = 1 << 31
RESULT = "query_id long, item_id long, score double"


def first_vector(vectors: DataFrame, key: str, vector: str) -> Column:
    """The vector with the smallest key, as a scalar subquery."""
    return vectors.agg(F.min_by(vector, key)).scalar()


def similarity_to_first(vectors: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    """Cosine of the first vector with every other one, and ``more`` columns."""
    first_key = vectors.agg(F.min(key)).scalar()
    others = vectors.filter(F.col(key) != first_key).withColumn("_first", first_vector(vectors, key, vector))
    return others.select(key, F.round(cosine(F.col("_first"), F.col(vector)), DIGITS).alias("score"), *more)


def with_codes(vectors: DataFrame, vector: str, code: str = "code") -> DataFrame:
    """Add the sign bits in 64-bit words, to be stored and searched instead of the vectors."""
    return vectors.withColumn(code, sign_words(F.col(vector)))


def hamming_then_cosine(
    coded: DataFrame, key: str, vector: str, query: Column, shortlist: int, k: int | None = None, code: str = "code"
) -> DataFrame:
    """``(key, distance, score, rank)``: the ``k`` best by cosine of the ``shortlist`` nearest by sign bits.

    ``coded`` holds the codes of ``with_codes``; only the shortlist's vectors are compared. Ties go by key.
    """
    asked = coded.withColumn("_query", query)
    distance = hamming(F.col(code), sign_words(F.col("_query"))).alias("distance")
    near = asked.select(key, vector, "_query", distance).orderBy("distance", key).limit(shortlist)
    scored = near.select(key, "distance", F.round(cosine(F.col(vector), F.col("_query")), DIGITS).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)))  # of one shortlist
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def matrix_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _bytes(queries: DataFrame, vector: str) -> int:
    return queries.agg(F.coalesce(F.sum(F.size(vector)), F.lit(0))).first()[0] * 8


def top_k(
    items: DataFrame, item_key: str, item_vector: str,
    queries: DataFrame, query_key: str, query_vector: str,
    k: int, include_self: bool = True, batch_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` nearest items of every query: ``(query_id, item_id, score, rank)``.

    Queries go to every task in chunks of at most ``batch_bytes``; the items are scanned once per chunk, without a
    shuffle, and only the best of each task travel.
    """
    items = items.select(F.col(item_key).cast("long").alias("id"), F.col(item_vector).alias("v"))
    queries = queries.select(F.col(query_key).cast("long").alias("id"), F.col(query_vector).alias("v"))
    chunks = query_chunks(queries, "id", _bytes(queries, "v"), batch_bytes)
    partial = reduce(DataFrame.union, [_scan(items, chunk, k, include_self) for chunk in chunks])
    return rank_scores(partial, "query_id", "item_id", "score", k)


def _score(best: BestScores, query_ids, query_matrix, item_ids, item_matrix, include_self: bool) -> None:
    for part in score_slices(len(item_ids), len(query_ids)):
        scores = query_matrix @ item_matrix[part].T
        if not include_self:
            scores[query_ids[:, None] == item_ids[part][None, :]] = -np.inf
        best.add(scores, item_ids[part])


def _result(best: BestScores, query_ids: np.ndarray) -> pd.DataFrame:
    position, item, score = best.rows()
    return pd.DataFrame({"query_id": query_ids[position], "item_id": item, "score": score})


def _scan(items: DataFrame, queries: DataFrame, k: int, include_self: bool) -> DataFrame:
    rows = queries.orderBy("id").collect()
    ids = np.array([row["id"] for row in rows], dtype=np.int64)
    matrix = unit_rows(np.array([row["v"] for row in rows], dtype=np.float64)) if rows else np.zeros((0, 0))
    shared = items.sparkSession.sparkContext.broadcast((ids, matrix))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_matrix = shared.value
        best = BestScores(len(query_ids), k)
        for batch in batches:
            if batch.num_rows and len(query_ids):
                item_ids = batch.column("id").to_numpy()
                _score(best, query_ids, query_matrix, item_ids, unit_rows(matrix_of(batch.column("v"))), include_self)
        yield pa.RecordBatch.from_pandas(_result(best, query_ids), preserve_index=False)

    return items.mapInArrow(scan, RESULT)


def all_pairs_top_k(vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The dot matrix of a table with itself, kept to the ``k`` best other items of every row.

    The work is quadratic; that of a task is bounded, as the number of tasks grows with the pairs.
    """
    n, size = vectors.count(), _bytes(vectors, vector)
    together = -(-n // max(1, -(-size // BROADCAST_BYTES)))  # queries of a chunk
    tasks = -(-n * together // TASK_PAIRS)
    items = vectors.select(key, vector)
    items = items.repartition(tasks) if tasks > items.rdd.getNumPartitions() else items
    return top_k(items, key, vector, vectors, key, vector, k, include_self=False)


def _row_blocks(rows: DataFrame, key: str, vector: str, block_rows: int) -> DataFrame:
    """``block, keys, matrix``: the rows of each task in blocks of at most ``block_rows``, the vectors one after the other."""
    kind = rows.schema[key].dataType.simpleString()

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                keys = pa.ListArray.from_arrays([0, part.num_rows], part.column(0))
                matrix = pa.array([matrix_of(part.column(1)).ravel()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([block]), keys, matrix], ["block", "keys", "matrix"])
                block += 1

    return rows.select(key, vector).mapInArrow(blocked, f"block long, keys array<{kind}>, matrix array<double>")


def _ordered_blocks(rows: DataFrame, key: str, vector: str, blocks: int) -> DataFrame:
    """``no, matrix``: all vectors by ascending key, null ones first, in about so many ranges of keys, numbered in order.

    Equal keys are ordered by their vectors, so that a key of very many rows is cut like any other.
    """
    ranges = rows.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).repartitionByRange(blocks, "k", "v").sortWithinPartitions("k", "v")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix_of(batch.column(1)) for batch in batches if batch.num_rows]
        if parts:
            matrix = pa.array([np.concatenate(parts).ravel()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([sum(map(len, parts))]), matrix], ["no", "width", "matrix"])

    return ranges.mapInArrow(numbered, "no int, width long, matrix array<double>")


def dot_matrix(
    left: DataFrame, left_key: str, left_vector: str, right: DataFrame, right_key: str, right_vector: str,
    batch_bytes: int = BROADCAST_BYTES, block_rows: int = 4096,
) -> DataFrame:
    """``left @ right.T`` as one row per left vector: ``(left_key, scores)``, scores in order of the right keys.

    Both sides are cut into blocks, the right one into ranges of keys of about ``batch_bytes``, null keys first. Every
    block of the left is dealt once to every range and meets it by an equi-join on the range's number (by a broadcast
    only if the right side is measured small); with several ranges, the pieces of a left block meet in a shuffle and are
    put together by their numbers. Null vectors are left out on both sides; rows that repeat a key are rows of their own.
    """
    left, right = left.filter(F.col(left_vector).isNotNull()), right.filter(F.col(right_vector).isNotNull())
    ranges = max(1, -(-_bytes(right, right_vector) // batch_bytes))
    columns = written(_ordered_blocks(right, right_key, right_vector, ranges), "column-blocks")
    numbers = sorted(row["no"] for row in columns.select("no").collect())  # as many as there are ranges
    if not numbers:
        return left.select(left_key, F.array().cast("array<double>").alias("scores"))
    kind = left.schema[left_key].dataType.simpleString()
    rows = _row_blocks(left, left_key, left_vector, block_rows).withColumn("no", F.explode(F.lit(numbers)))
    met = rows.withColumnRenamed("matrix", "row_matrix").join(broadcast_if_small(columns, BROADCAST_BYTES), "no")

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, width = batch.column("keys")[i].values, batch.column("width")[i].as_py()
                one, two = (batch.column(c)[i].values.to_numpy() for c in ("row_matrix", "matrix"))
                scores = one.reshape(len(keys), -1) @ two.reshape(width, -1).T
                place = batch.column("block")[i].as_py()
                lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * width, scores.ravel())
                columns = [pa.array(np.full(len(keys), place)), pa.array(np.arange(len(keys), dtype=np.int32)), keys, pa.array(np.full(len(keys), batch.column("no")[i].as_py(), np.int32)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["block", "place", "key", "no", "scores"])

    pieces = met.select("block", "keys", "row_matrix", "no", "width", "matrix").mapInArrow(multiplied, f"block long, place int, key {kind}, no int, scores array<double>")
    if len(numbers) > 1:
        pieces = pieces.groupBy("block", "place").agg(F.first("key").alias("key"), F.sort_array(F.collect_list(F.struct("no", "scores"))).alias("parts"))
        pieces = pieces.withColumn("scores", F.flatten("parts.scores"))
    return pieces.select(F.col("key").alias(left_key), "scores")
