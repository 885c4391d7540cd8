"""Top-k per query with a bounded merge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

DIGITS = 6
SCORE_CELLS = 1 << 22


def rank_scores(scored: DataFrame, query: str, item: str, score: str, k: int) -> DataFrame:
    """The ``k`` best items per query, smaller item id first on equal scores; ``rank`` from 1."""
    order = Window.partitionBy(query).orderBy(F.desc(score), F.col(item))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def score_slices(items: int, queries: int) -> Iterator[slice]:
    """Runs of items whose score matrix with all queries stays below ``SCORE_CELLS``."""
    step = max(1, SCORE_CELLS // max(queries, 1))
    return (slice(start, min(start + step, items)) for start in range(0, items, step))


def query_chunks(queries: DataFrame, key: str, size: int, batch_bytes: int) -> list[DataFrame]:
    """Queries of a measured ``size`` in chunks of about ``batch_bytes``, all rows of a key in the same one."""
    chunks = max(1, -(-size // batch_bytes))
    if chunks == 1:
        return [queries]
    chunk = F.pmod(F.xxhash64(key), F.lit(chunks))
    return [queries.filter(chunk == no) for no in range(chunks)]


class BestScores:
    """The ``k`` best (score, item) of each query seen so far in one task, as arrays of shape (queries, k)."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, 0), -np.inf)
        self.items = np.zeros((queries, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, items: np.ndarray) -> None:
        """``scores`` has one row per query and one column per item; ``-inf`` marks a pair to leave out."""
        if self.scores.shape[1] == self.k:
            # Once k are known, few scores reach the worst of them; only these are rounded and sorted.
            least = np.maximum(self.scores[:, -1] - 10.0**-DIGITS, np.finfo(float).min)
            query, column = np.nonzero(scores >= least[:, None])
            if len(query) <= scores.size // 8:
                possible = np.isfinite(scores[query, column])
                query, column = query[possible], column[possible]
                met = np.unique(query)
                known, place = np.nonzero(np.isfinite(self.scores[met]))
                known = met[known]
                self._keep(
                    met,
                    np.concatenate([known, query]),
                    np.concatenate([self.scores[known, place], np.round(scores[query, column], DIGITS) + 0.0]),
                    np.concatenate([self.items[known, place], items[column]]),
                )
                return
        rounded = np.round(scores, DIGITS) + 0.0
        merged = np.concatenate([self.scores, rounded], axis=1)
        ids = np.concatenate([self.items, np.broadcast_to(items, rounded.shape)], axis=1)
        possible = np.isfinite(merged)
        if merged.shape[1] > self.k:
            possible &= merged >= -np.partition(-merged, self.k - 1, axis=1)[:, self.k - 1: self.k]
        query, column = np.nonzero(possible)
        self.scores = np.full((len(merged), self.k), -np.inf)
        self.items = np.zeros((len(merged), self.k), dtype=np.int64)
        self._keep(slice(None), query, merged[query, column], ids[query, column])

    def _keep(self, queries: np.ndarray | slice, query: np.ndarray, score: np.ndarray, item: np.ndarray) -> None:
        """Make the best of the given entries the rows of ``queries``, which are all that occur in ``query``."""
        order = np.lexsort((item, -score, query))
        query, score, item = query[order], score[order], item[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.scores[queries], self.items[queries] = -np.inf, 0
        self.scores[query[kept], place[kept]] = score[kept]
        self.items[query[kept], place[kept]] = item[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query positions, items and scores of what was kept."""
        query, place = np.nonzero(np.isfinite(self.scores))
        return query, self.items[query, place], self.scores[query, place]
