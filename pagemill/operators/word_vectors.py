"""Word2Vec (skip-gram) whose vocabulary may outgrow every machine: an estimator for ML pipelines.

The most frequent words, the head, are trained with negative sampling, in tasks over their own rows whose vectors are
averaged. Every other word that occurs ``min_count`` times, the tail, gets its vector from all its contexts: their mean
vector times the matrix that best takes the head's mean contexts to the head's vectors (Khodak et al., "A La Carte
Embedding", 2018). Tail words stay in a table; no more than the head is ever on the driver or in a broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import written

#: Words trained by steps and known to every task: at most this many, none longer than this, so never more than some 30 MB.
HEAD_WORDS = 100_000
HEAD_WORD_BYTES = 256
WINDOW = 5
CHUNKS = 256, 4096
NEGATIVES, SHARED = 5, 16
RATE = 0.25


class WordVectors(Estimator, HasInputCol, HasOutputCol):
    """Learn a vector for every word that occurs ``min_count`` times in the arrays of ``input_col``, in ``partitions`` tasks."""

    def __init__(self, input_col: str, output_col: str, size: int, seed: int, min_count: int = 5, partitions: int = 1, head_words: int = HEAD_WORDS):
        super().__init__()
        self._set(inputCol=input_col, outputCol=output_col)
        self.size, self.seed, self.min_count, self.partitions, self.head_words = size, seed, min_count, partitions, head_words

    def _fit(self, dataset: DataFrame) -> WordVectorsModel:
        tokens = dataset.select(F.coalesce(self.getInputCol(), F.array().cast("array<string>")).alias("tokens"))
        counted = written(_counts(tokens).filter(F.col("n") >= self.min_count), "word-counts")
        short = counted.filter(F.octet_length("word") <= HEAD_WORD_BYTES)
        head = short.orderBy(F.desc("n"), "word").limit(self.head_words).toPandas()
        vectors = _trained(tokens, head, self.size, self.seed, self.partitions)
        terms = pa.array(head["word"].astype(str), pa.string())
        tail = None
        if counted.count() > len(head):
            tail = written(_tail(tokens, terms, vectors, self.min_count), "tail-words")
        return WordVectorsModel(self.getInputCol(), self.getOutputCol(), terms, vectors, tail)


class WordVectorsModel(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """``head`` words and their ``vectors`` as arrays, ``tail(word, v)`` as a table or None."""

    def __init__(self, input_col: str | None = None, output_col: str | None = None, head: pa.Array | None = None, vectors: np.ndarray | None = None, tail: DataFrame | None = None):
        super().__init__()
        if input_col is not None:
            self._set(inputCol=input_col, outputCol=output_col)
        self.head, self.vectors, self.tail = head, vectors, tail

    def vectors_table(self) -> DataFrame:
        """``word, v``: every known word and its vector."""
        rows = pd.DataFrame({"word": self.head.to_pylist(), "v": [list(map(float, v)) for v in self.vectors]})
        head = SparkSession.active().createDataFrame(rows, "word string, v array<double>")
        return head if self.tail is None else head.unionByName(self.tail)

    def getVectors(self) -> DataFrame:
        return self.vectors_table().select("word", array_to_vector("v").alias("vector"))

    def summed(self, documents: DataFrame) -> DataFrame:
        """Add ``_known``, how many tokens are known, and ``_sum``, the sum of their vectors.

        Head words are summed where the document is. The other tokens meet the tail by a join on the word, and go back to
        their documents by a hash of them, under which equal lists are counted together. Each side cuts the tokens once.
        """
        tokens = F.coalesce(self.getInputCol(), F.array().cast("array<string>"))
        rows = documents.withColumn("_head", _fold(self.head, self.vectors, self.tail is not None)(tokens))
        if self.tail is None:
            return rows.withColumns({"_known": F.col("_head.known"), "_sum": F.col("_head.total")}).drop("_head")
        # Documents without other tokens meet nothing; a key of their own kind deals them over the tasks.
        key = F.coalesce("_head.key", F.unhex(F.hex(F.xxhash64(tokens))))
        rows = rows.withColumns({"_key": key, "_known": F.col("_head.known"), "_sum": F.col("_head.total")})
        others = _others(documents.select(tokens.alias("tokens")), self.head)
        size = self.vectors.shape[1]
        sums = [F.sum(F.col("v")[i] * F.col("n")) for i in range(size)]
        lists = F.sum("lists")
        found = others.join(self.tail, "word", "left").groupBy("_key").agg(
            (F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)) / lists).cast("long").alias("_more"),
            F.transform(F.array(*sums), lambda x: F.coalesce(x, F.lit(0.0)) / lists).alias("_tail"),
        )
        joined = rows.drop("_head").join(found.filter("_more > 0"), "_key", "left").drop("_key")
        return joined.withColumns({
            "_known": F.col("_known") + F.coalesce("_more", F.lit(0)),
            "_sum": F.when(F.col("_more").isNull(), F.col("_sum")).otherwise(F.zip_with("_sum", "_tail", lambda a, b: a + b)),
        }).drop("_more", "_tail")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add the mean over all tokens; unknown ones count as zero, and a list without tokens has the zero vector.

        Tokens are counted before the join, which they need not go through unless they are asked for.
        """
        tokens = F.greatest(F.coalesce(F.size(self.getInputCol()), F.lit(0)), F.lit(1))
        mean = F.transform("_sum", lambda x: x / F.col("_tokens"))
        summed = self.summed(dataset.withColumn("_tokens", tokens))
        return summed.withColumn(self.getOutputCol(), array_to_vector(mean)).drop("_known", "_sum", "_tokens")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: WordVectorsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model = self.model
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, {"size": model.vectors.shape[1], "tail": model.tail is not None})
        model_head = WordVectorsModel(head=model.head, vectors=model.vectors)
        model_head.vectors_table().write.parquet(f"{path}/head")
        if model.tail is not None:
            model.tail.write.parquet(f"{path}/tail")


class _ModelReader(MLReader):
    def load(self, path: str) -> WordVectorsModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/head").toPandas()
        vectors = np.array(rows["v"].tolist(), dtype=float).reshape(len(rows), metadata["size"])
        tail = spark.read.parquet(f"{path}/tail") if metadata["tail"] else None
        model = WordVectorsModel(head=pa.array(rows["word"].astype(str), pa.string()), vectors=vectors, tail=tail)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _counts(tokens: DataFrame) -> DataFrame:
    """``word, n``, counted in the batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column(0).flatten())
            yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])

    return tokens.mapInArrow(count, "word string, n long").filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))


def _placed(lists: pa.ListArray, head: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Tokens of a batch, the row of each, and its place in the head or -1."""
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return flat, row, pc.fill_null(pc.index_in(flat, value_set=head), -1).to_numpy()


class SkipGram:
    """Vectors in training: every word predicts those around it against drawn ones, in steps scaled by past gradients."""

    def __init__(self, counts: np.ndarray, size: int, seed: int, task: int):
        start = np.random.default_rng(seed)
        self.vectors = ((start.random((len(counts), size)) - 0.5) / size).astype(np.float32)
        self.outputs = np.zeros_like(self.vectors)
        self.past = [np.ones_like(self.vectors), np.ones_like(self.vectors)]
        self.draw = np.random.default_rng([seed, task])
        noise = np.cumsum(counts.astype(float) ** 0.75)
        self.noise = noise / noise[-1] if len(noise) else noise
        self.seen = np.zeros(len(counts), np.int64)

    def add(self, words: np.ndarray, row: np.ndarray) -> None:
        """Learn from all pairs of words of a row that are at most a drawn number of places apart."""
        window, start, before = self.draw.integers(1, WINDOW + 1, len(words)), 0, self.seen.sum()
        while start < len(words):
            chunk = min(max(CHUNKS[0], (before + start) // 16), CHUNKS[1])  # steps grow with what is known
            part = slice(start, start + chunk + WINDOW)
            self._step(words[part], row[part], window[part], min(chunk, len(words) - start))
            start += chunk
        self.seen += np.bincount(words, minlength=len(self.seen))

    def _step(self, words: np.ndarray, row: np.ndarray, window: np.ndarray, first: int) -> None:
        known, place = np.unique(words, return_inverse=True)
        v, u = (np.ascontiguousarray(m[words].T) for m in (self.vectors, self.outputs))
        gv, gu, pairs = np.zeros_like(v), np.zeros_like(u), np.zeros(len(words), np.float32)
        for apart in range(1, WINDOW + 1):
            n = min(first, len(words) - apart)
            if n <= 0:
                break
            left, right = slice(0, n), slice(apart, apart + n)
            same = row[left] == row[right]
            for a, b in ((left, right), (right, left)):
                g = (same & (window[a] >= apart)).astype(np.float32)
                pairs[a] += g
                g *= 1 - _sigmoid(np.einsum("ij,ij->j", v[:, a], u[:, b]))
                gv[:, a] += g * u[:, b]
                gu[:, b] += g * v[:, a]
        drawn, copies = np.unique(np.searchsorted(self.noise, self.draw.random(SHARED)), return_counts=True)
        against = self.outputs[drawn]
        g = -_sigmoid(against @ v) * (pairs * NEGATIVES / SHARED) * copies[:, None].astype(np.float32)
        gv += against.T @ g
        self._move(self.vectors, self.past[0], known, _by_word(gv, place, len(known)))
        self._move(self.outputs, self.past[1], known, _by_word(gu, place, len(known)))
        self._move(self.outputs, self.past[1], drawn, g @ v.T)

    @staticmethod
    def _move(matrix: np.ndarray, past: np.ndarray, words: np.ndarray, gradient: np.ndarray) -> None:
        past[words] += gradient * gradient
        matrix[words] += RATE * gradient / np.sqrt(past[words])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _by_word(gradient: np.ndarray, place: np.ndarray, words: int) -> np.ndarray:
    return np.stack([np.bincount(place, line, words) for line in gradient], axis=1).astype(np.float32)


def _trained(tokens: DataFrame, head: pd.DataFrame, size: int, seed: int, partitions: int) -> np.ndarray:
    """Vectors of the head's words: the mean of what the tasks learned, weighted by how often each saw the word."""
    terms, counts = pa.array(head["word"].astype(str), pa.string()), head["n"].to_numpy(dtype=np.int64)
    shared = tokens.sparkSession.sparkContext.broadcast((terms, counts))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = shared.value
        model = SkipGram(n, size, seed, TaskContext.get().partitionId())
        for batch in batches:
            _, row, place = _placed(batch.column(0), known)
            model.add(place[place >= 0], row[place >= 0])
        word = np.nonzero(model.seen)[0]
        weight = model.seen[word].astype(float)
        columns = [pa.array(x) for x in (word, weight, *(model.vectors[word].T * weight))]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n", *_names(size)])

    learned = tokens.coalesce(partitions).mapInArrow(train, ", ".join(["word long", "n double", *(f"{c} double" for c in _names(size))]))
    means = learned.groupBy("word").agg(*(F.sum(c).alias(c) for c in ["n", *_names(size)])).toPandas()
    vectors = np.zeros((len(head), size))
    vectors[means["word"].to_numpy(dtype=np.int64)] = means[_names(size)].to_numpy() / means[["n"]].to_numpy()
    return vectors


def _names(size: int) -> list[str]:
    return [f"s{i}" for i in range(size)]


def context_sums(row: np.ndarray, place: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token, the sum of the vectors of the ``WINDOW`` head words on each side in its row, and their number."""
    here = place >= 0
    total = np.concatenate([np.zeros((1, vectors.shape[1])), np.cumsum(vectors[place[here]], axis=0)])
    after = np.cumsum(here)  # head words up to a token, itself included
    before = after - here
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(row)))
    first = np.maximum(before - WINDOW, before[starts][run])
    last = np.minimum(after + WINDOW, np.append(before[starts], after[-1:])[1:][run])
    return total[last] - total[after] + total[before] - total[first], last - after + before - first


def _tail(tokens: DataFrame, head: pa.Array, vectors: np.ndarray, min_count: int) -> DataFrame:
    """``word, v`` of every word outside the head that occurs ``min_count`` times."""
    size = vectors.shape[1]
    shared = tokens.sparkSession.sparkContext.broadcast((head, vectors))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, learned = shared.value
        own = np.zeros((len(known), size + 2))
        for batch in batches:
            flat, row, place = _placed(batch.column(0), known)
            around, number = context_sums(row, place, learned)
            every = np.column_stack([np.ones(len(row)), number, around])
            own += _sums(place[place >= 0], every[place >= 0], len(known))
            other = flat.filter(pa.array(place < 0)).dictionary_encode()
            sums = _sums(other.indices.to_numpy(), every[place < 0], len(other.dictionary))
            yield _sum_batch(other.dictionary, pa.nulls(len(sums), pa.int64()), sums)
        seen = np.nonzero(own[:, 0])[0]
        yield _sum_batch(pa.nulls(len(seen), pa.string()), pa.array(seen), own[seen])

    names = ["n", "m", *_names(size)]
    schema = ", ".join(["word string", "head long", *(f"{c} double" for c in names)])
    partial = written(tokens.mapInArrow(meet, schema), "contexts")
    sums = [F.sum(c).alias(c) for c in names]
    own = partial.filter("head is not null").groupBy("head").agg(*sums).filter("m > 0").toPandas()
    weight = np.sqrt(own[["m"]].to_numpy())
    matrix, *_ = np.linalg.lstsq(own[_names(size)].to_numpy() / weight, vectors[own["head"].to_numpy(dtype=np.int64)] * weight, rcond=None)
    mean = [sum((F.col(c) * float(matrix[i, j]) for i, c in enumerate(_names(size))), F.lit(0.0)) / F.greatest("m", F.lit(1.0)) for j in range(size)]
    words = partial.filter("word is not null").groupBy("word").agg(*sums).filter(F.col("n") >= min_count)
    return words.select("word", F.array(*mean).alias("v"))


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.column_stack([np.bincount(place, column, n) for column in values.T])


def _sum_batch(word: pa.Array, head: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
    names = ["word", "head", "n", "m", *_names(sums.shape[1] - 2)]
    return pa.RecordBatch.from_arrays([word, head, *(pa.array(c) for c in sums.T)], names)


def _rest(flat: pa.Array, row: np.ndarray, place: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray, list[bytes | None]]:
    """Tokens outside the head, the row of each, and for each of ``n`` rows a key of its list of them."""
    outside = place < 0
    rest, owner = flat.filter(pa.array(outside)).cast(pa.large_string()), row[outside]
    edges = np.searchsorted(owner, np.arange(n + 1))
    words, lengths = rest.to_pylist(), pc.binary_length(rest).to_numpy()
    keys = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        joined = hashlib.blake2b(lengths[a:b].tobytes(), digest_size=16)
        joined.update("".join(words[a:b]).encode())
        keys.append(joined.digest() if b > a else None)
    return rest.cast(pa.string()), owner, keys


def _fold(head: pa.Array, vectors: np.ndarray, keyed: bool):
    """A function of token lists: ``known`` and ``total`` of their head words, and a ``key`` of their other words."""
    shared = SparkSession.active().sparkContext.broadcast((head, vectors))

    def fold(lists: pa.Array) -> pa.Array:
        known, learned = shared.value
        n = len(lists)
        flat, row, place = _placed(lists, known)
        here = place >= 0
        total = _sums(row[here], learned[place[here]], n)
        totals = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * total.shape[1], total.ravel())
        columns = [pa.array(np.bincount(row[here], minlength=n)), totals]
        if not keyed:
            return pa.StructArray.from_arrays(columns, ["known", "total"])
        *_, keys = _rest(flat, row, place, n)
        return pa.StructArray.from_arrays([*columns, pa.array(keys, pa.binary())], ["known", "total", "key"])

    return F.arrow_udf(fold, f"struct<known: long, total: array<double>{', key: binary' if keyed else ''}>")


def _others(tokens: DataFrame, head: pa.Array) -> DataFrame:
    """``_key, word, n, lists``: the distinct words outside the head of every list, how often each occurs there, and 1 in one row
    of the list."""
    shared = tokens.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            words, owner, keys = _rest(*_placed(lists, shared.value), len(lists))
            encoded = words.dictionary_encode()
            terms = max(len(encoded.dictionary), 1)
            pair, n = np.unique(owner * terms + encoded.indices.to_numpy(), return_counts=True)
            row = pair // terms
            columns = [pa.array(keys, pa.binary()).take(pa.array(row)), encoded.dictionary.take(pa.array(pair % terms))]
            first = np.diff(row, prepend=-1) > 0
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(first.astype(np.int64))], ["_key", "word", "n", "lists"])

    return tokens.mapInArrow(count, "_key binary, word string, n long, lists long")
