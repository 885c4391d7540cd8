"""Multi-index hashing: all codes within a Hamming distance of a batch of queries, without scanning per query.

A code is cut into parts. If two codes differ in at most ``r`` bits, some part differs in no more than its share of them,
so every neighbour shares, with a part of the query changed in that many bits, one exact value: an equi-join key. A pair
is kept at the first part that brings it together, so that no pair comes twice, and only if the whole codes are near.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.vectors import hamming
from pagemill.session import broadcast_if_small, written


def parts_of(words: int, parts_per_word: int) -> list[tuple[int, int, int]]:
    """``(word, shift, bits)`` of every part; the parts of a word are equally long, give or take a bit."""
    cuts = [64 * i // parts_per_word for i in range(parts_per_word + 1)]
    return [(word, low, high - low) for word in range(words) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]


def shares(radius: int, parts: int) -> list[int]:
    """Bits in which each part may differ: of two codes within the radius, some part stays within its share (-1: none)."""
    share, more = divmod(radius, parts)
    return [share if i <= more else share - 1 for i in range(parts)]


def _part(code: Column, word: int, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(code[word], shift).bitwiseAND((1 << bits) - 1) if bits < 64 else code[word]


def code_index(coded: DataFrame, key: str, code: str, words: int, parts_per_word: int = 4) -> DataFrame:
    """A written row ``part, value, id, code`` for every part of every code that is not null and has ``words`` words."""
    rows = coded.filter(F.col(code).isNotNull() & (F.size(code) == words)).select(F.col(key).alias("id"), F.col(code).alias("code"))
    values = F.array(*(_part(F.col("code"), *p) for p in parts_of(words, parts_per_word)))
    return written(rows.select(F.posexplode(values).alias("part", "value"), "id", "code"), "code-index")


def changed(values: np.ndarray, bits: int, most: int) -> np.ndarray:
    """A row for every value: the value with every set of at most ``most`` bits flipped."""
    masks = [sum(1 << i for i in flips) for n in range(most + 1) for flips in combinations(range(bits), n)]
    return values[:, None] ^ np.array(masks, np.uint64).astype(np.int64)[None, :]


def within_radius(index: DataFrame, queries: DataFrame, key: str, code: str, radius: int, words: int, parts_per_word: int = 4) -> DataFrame:
    """``query_id, id, distance`` of all indexed codes within ``radius`` bits of every query, the query's own included.

    The queries' values meet the index by a broadcast if they are few, else by a shuffle on (part, value), in which
    adaptive execution splits a value that very many codes share.
    """
    parts = parts_of(words, parts_per_word)
    allowed = shares(radius, len(parts))
    kind = queries.schema[key].dataType.simpleString()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, words)
            for part, ((word, shift, bits), most) in enumerate(zip(parts, allowed, strict=True)):
                if most < 0 or not batch.num_rows:
                    continue
                own = (codes[:, word].astype(np.uint64) >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
                values = changed(own.view(np.int64), bits, min(most, bits))
                step = max(1, (1 << 20) // values.shape[1])
                for start in range(0, len(values), step):
                    piece = values[start : start + step]
                    rows = batch.slice(start, len(piece)).take(pa.array(np.repeat(np.arange(len(piece)), piece.shape[1])))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(piece.size, part, np.int32)), pa.array(piece.ravel()), *rows.columns], ["part", "value", "query_id", "query_code"])

    sound = queries.filter(F.col(code).isNotNull() & (F.size(code) == words)).select(F.col(key).alias("query_id"), F.col(code).alias("query_code"))
    values = written(sound.mapInArrow(asked, f"part int, value long, query_id {kind}, query_code array<bigint>"), "query-values")
    gaps = [F.bit_count(_part(F.col("code"), *p).bitwiseXOR(_part(F.col("query_code"), *p))) for p in parts]
    first = F.coalesce(*(F.when(gap <= most, i) for i, (gap, most) in enumerate(zip(gaps, allowed, strict=True))))
    distance = hamming(F.col("code"), F.col("query_code"))
    near = reduce(Column.__and__, [distance <= radius, first == F.col("i.part")])
    met = index.alias("i").join(broadcast_if_small(values).alias("q"), (F.col("i.part") == F.col("q.part")) & (F.col("i.value") == F.col("q.value")) & near)
    return met.select("query_id", "id", distance.alias("distance"))
