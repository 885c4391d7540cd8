"""Inverted file of vectors: cells around learned centres, of which a query reads only the likely ones.

Vectors lie in blocks in a table partitioned by cell, so that cells that no query probes are not read. Queries are dealt to
their cells in chunks and meet blocks, never single vectors, by an equi-join on the cell; a block and a chunk make one
product of matrices. Scores are cosine similarities rounded to six digits, equal scores are ordered by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.nearest import matrix_of, unit_rows
from pagemill.operators.topk import BestScores, rank_scores, score_slices
from pagemill.session import broadcast_if_small, new_table_path, written

FOUND = "query_id long, item_id long, score double, cell int"
#: Bounds of cells give way by this much, beyond the rounding of scores.
SLACK = 2e-6


@dataclass(frozen=True)
class CellIndex:
    """A written index: ``blocks`` partitioned by cell below ``path``, and what is known of each cell (bounded by their number)."""

    path: str
    centres: np.ndarray  # unit vectors, a row for each cell
    reach: np.ndarray  # smallest cosine of a cell's vectors with its centre
    sizes: np.ndarray


def _learned(vectors: DataFrame, cells: int, sample_per_cell: int, seed: int) -> np.ndarray:
    """Unit centres from a sample of about ``sample_per_cell`` vectors for each cell, drawn by a hash of the key."""
    sound = vectors.filter(F.exists("v", lambda x: x != 0))
    rows = sound.count()
    if not rows:
        return np.zeros((0, 0))
    share = min(1.0, cells * sample_per_cell / rows)
    sample = sound.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    model = KMeans(k=cells, distanceMeasure="cosine", seed=seed, maxIter=10).fit(sample.select(array_to_vector("v").alias("features")))
    return unit_rows(np.array(model.clusterCenters(), dtype=np.float64))


def build_cells(
    vectors: DataFrame, key: str, vector: str, cells: int, path: str | None = None, sample_per_cell: int = 256, block_rows: int = 4096, seed: int = 17,
) -> CellIndex:
    """Write every vector that is not null into the block of its nearest centre's cell.

    Only the centres come from a sample (``sample_per_cell``); all vectors are indexed. A block holds about
    ``block_rows`` vectors, however many its cell has, and blocks of a large cell are written by several tasks. Fewer
    different vectors than ``cells`` make fewer cells; zero vectors lie in the first one.
    """
    spark = vectors.sparkSession
    path = path or new_table_path(spark, "cells")
    vectors = vectors.filter(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    centres = _learned(vectors, cells, sample_per_cell, seed)
    shared = spark.sparkContext.broadcast(centres)

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                cosine = unit_rows(matrix_of(part.column("v"))) @ shared.value.T if len(shared.value) else np.zeros((part.num_rows, 1))
                cell = cosine.argmax(axis=1)
                near = cosine[np.arange(len(cell)), cell]
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *part.columns, pa.array(near)], ["cell", "id", "v", "near"])

    assigned = written(vectors.mapInArrow(placed, "cell int, id long, v array<double>, near double"), "placed")
    known = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.min("near").alias("reach")).collect()  # a row per cell
    sizes, reach = np.zeros(max(len(centres), 1), np.int64), np.ones(max(len(centres), 1))
    for row in known:
        sizes[row["cell"]], reach[row["cell"]] = row["n"], row["reach"]
    blocks = F.element_at(F.lit([int(-(-n // block_rows)) or 1 for n in sizes]), F.col("cell") + 1)
    pieces = assigned.withColumn("block", F.pmod(F.xxhash64("id", "v"), blocks).cast("int"))
    grouped = pieces.groupBy("cell", "block").agg(F.collect_list(F.struct("id", "v")).alias("rows"))  # about block_rows of them
    made = grouped.select("block", F.col("rows.id").alias("ids"), F.flatten("rows.v").alias("matrix"), "cell")
    made.write.partitionBy("cell").parquet(f"{path}/blocks")
    return CellIndex(path, centres, reach, sizes)


def _ranking(index: CellIndex, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of every query from the nearest on, and the best score that a vector of each cell can have."""
    unit = unit_rows(queries)
    cosine = np.clip(unit @ index.centres.T, -1, 1)
    angle = np.arccos(cosine) - np.arccos(np.clip(index.reach, -1, 1))
    bound = np.cos(np.maximum(angle, 0)) + SLACK
    bound[~unit.any(axis=1)] = SLACK  # a zero vector scores zero everywhere
    return np.argsort(-cosine, axis=1, kind="stable"), bound


def _probed(index: CellIndex, queries: DataFrame, probes: int, rest: bool) -> DataFrame:
    """``cell, id, v``: each query with its ``probes`` nearest cells, or with the others that can still matter to it.

    ``queries`` have ``least``, the score that a vector must reach.
    """
    shared = queries.sparkSession.sparkContext.broadcast(index)

    def dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                order, bound = _ranking(shared.value, matrix_of(part.column("v")))
                wanted = np.zeros(order.shape, bool)
                wanted[:, :probes] = True
                if rest:
                    least = part.column("least").to_numpy()
                    wanted = ~wanted & (np.take_along_axis(bound, order, 1) >= least[:, None])
                query, place = np.nonzero(wanted)
                cell = order[query, place]
                held = shared.value.sizes[cell] > 0
                taken = part.take(pa.array(query[held]))
                yield pa.RecordBatch.from_arrays([pa.array(cell[held].astype(np.int32)), taken.column("id"), taken.column("v")], ["cell", "id", "v"])

    return queries.mapInArrow(dealt, "cell int, id long, v array<double>")


def blocks_of(index: CellIndex, spark, cells: list[int]) -> DataFrame:
    """The blocks of some cells; others' files are not opened."""
    return spark.read.schema("block int, ids array<long>, matrix array<double>, cell int").parquet(f"{index.path}/blocks").filter(F.col("cell").isin(cells))


def _scored(index: CellIndex, asked: DataFrame, k: int, include_self: bool, chunk_rows: int) -> DataFrame:
    """The ``k`` best of every block for every query that asks its cell."""
    asked = written(asked, "asked")
    per_cell = asked.groupBy("cell").count().collect()  # a row per cell
    chunks = max((-(-row["count"] // chunk_rows) for row in per_cell), default=1)
    chunk = F.pmod(F.xxhash64("id", "v"), F.lit(chunks))
    together = asked.groupBy("cell", chunk.alias("chunk")).agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    together = together.select("cell", F.col("rows.id").alias("query_ids"), F.flatten("rows.v").alias("queries"))
    met = blocks_of(index, asked.sparkSession, [row["cell"] for row in per_cell]).join(broadcast_if_small(together), "cell")

    def best_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                cell, ids, matrix, query_ids, queries = (part.column(c)[i] for c in ("cell", "ids", "matrix", "query_ids", "queries"))
                ids, query_ids = ids.values.to_numpy(), query_ids.values.to_numpy()
                items, asks = unit_rows(matrix.values.to_numpy().reshape(len(ids), -1)), unit_rows(queries.values.to_numpy().reshape(len(query_ids), -1))
                best = BestScores(len(query_ids), k)
                for piece in score_slices(len(ids), len(query_ids)):
                    scores = asks @ items[piece].T
                    if not include_self:
                        scores[query_ids[:, None] == ids[piece][None, :]] = -np.inf
                    best.add(scores, ids[piece])
                position, item, score = best.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[position]), pa.array(item), pa.array(score), pa.array(np.full(len(item), cell.as_py(), np.int32))], ["query_id", "item_id", "score", "cell"]
                )

    return met.select("cell", "ids", "matrix", "query_ids", "queries").mapInArrow(best_of, FOUND)


def search_cells(
    index: CellIndex, queries: DataFrame, key: str, vector: str, k: int, probes: int, exact: bool = False, include_self: bool = True, chunk_rows: int = 1024,
) -> DataFrame:
    """``query_id, item_id, score, cell, rank``: the ``k`` best of the ``probes`` nearest cells of every query.

    With ``exact``, cells that may hold a vector as good as a query's k-th so far are read as well, by the angle between
    centre and query and the reach of the cell; then the result is that of the whole table. Queries with null vectors
    have no result; keys of queries should differ.
    """
    asks = queries.filter(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    if not len(index.centres):
        return queries.sparkSession.createDataFrame([], FOUND + ", rank int")
    first = rank_scores(_scored(index, _probed(index, asks, probes, rest=False), k, include_self, chunk_rows), "query_id", "item_id", "score", k)
    if not exact or probes >= len(index.centres):
        return first
    first = written(first, "first-cells")
    least = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    open_asks = asks.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    more = _scored(index, _probed(index, open_asks, probes, rest=True), k, include_self, chunk_rows)
    return rank_scores(first.drop("rank").unionByName(more), "query_id", "item_id", "score", k)


def probes_for_recall(index: CellIndex, queries: DataFrame, key: str, vector: str, k: int, recall: float, sample: int = 256) -> int:
    """The fewest probes that find ``recall`` of the exact ``k`` best of a sample of at most ``sample`` queries."""
    some = queries.filter(F.col(vector).isNotNull()).orderBy(F.xxhash64(key), key).limit(sample)
    truth = written(search_cells(index, some, key, vector, k, probes=1, exact=True), "truth").select(F.col("query_id").alias("id"), "cell")
    asked = some.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).toPandas()  # at most sample rows
    if not len(asked) or not len(index.centres):
        return 1
    order, _ = _ranking(index, np.array(asked["v"].tolist()))
    place = np.argsort(order, axis=1)
    row_of = {q: i for i, q in enumerate(asked["id"])}
    ranks = np.sort([place[row_of[r["id"]], r["cell"]] for r in truth.collect()])
    return int(ranks[int(np.ceil(recall * len(ranks))) - 1]) + 1 if len(ranks) else 1
