"""A log-bilinear language model of words, trained with noise-contrastive estimation.

A word is predicted from the two before it: their vectors, each times a matrix of its place, add up to a vector whose
product with the word's own, and a bias, is the word's score. Words beyond the commonest are predicted as one of a number
of classes by how they begin, times their share of that class's count.

All statistics are over all training texts: counts of words by a shuffle that grows with them, and the parameters by steps
over every text, in which each task goes over its own texts and the tasks' parameters are averaged. As a model has only
two places, its normaliser of every pair of context words is one product of two matrices, and log-probabilities of whole
corpora are lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import LOWER, batches, buffers, lean, words
from pagemill.session import written

#: The word that ends every text. Any other word shares it with a chance of 1 in 2^64.
END = 0x9D39247E33776D41
#: Classes of words that have no vector of their own, by their first two bytes.
REST_CLASSES = 512
LN10 = float(np.log(10.0))


def text_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text's word hashes and one END, their rest classes, and where each text begins, with the end of the last."""
    hashes, starts, ends, at = words(texts)
    raw, _ = buffers(texts)
    bounds = at + np.arange(len(at))
    place = np.ones(bounds[-1], bool)
    place[bounds[1:] - 1] = False
    out, rest = np.full(bounds[-1], END, np.uint64), np.zeros(bounds[-1], np.int16)
    out[place] = hashes
    if len(hashes):
        second = np.where(ends - starts > 1, LOWER[raw[np.minimum(starts + 1, len(raw) - 1)]], 0).astype(np.int64)
        rest[place] = (LOWER[raw[starts]].astype(np.int64) * 31 + second) % REST_CLASSES
    return out, rest, bounds


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, rest, n`` of every different word of all texts, END included; a task counts 3 million words at a time."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            every, rest = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            word, first, n = np.unique(every, return_index=True, return_counts=True)
            return pa.record_batch([pa.array(word.view(np.int64)), pa.array(rest[first]), pa.array(n)], ["word", "rest", "n"])

        for part in lean(parts):
            for a, b in batches(part.column(0)):
                held.append(text_words(part.column(0).slice(a, b - a))[:2])
                if sum(len(x) for x, _ in held) >= 3_000_000:
                    yield flush()
        if held:
            yield flush()

    partial = docs.select(text).mapInArrow(counted, "word long, rest short, n long")
    return partial.groupBy("word").agg(F.min("rest").alias("rest"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Words with their counts; all arrays are bounded by parameters, whatever the corpus."""

    total: int  # words of all training texts
    distinct: int
    own: np.ndarray  # sorted words with a vector of their own; the class of own[i] is order[i]
    order: np.ndarray
    common: np.ndarray  # sorted common words and their counts: those that occur at least so often
    counts: np.ndarray
    least_common: int
    class_counts: np.ndarray  # by class: own words first, then the rest classes
    rest_size: np.ndarray  # log10 of count, different words and one, of each rest class

    @property
    def classes(self) -> int:
        return len(self.class_counts)


def _lookup(known: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: int) -> np.ndarray:
    if not len(known):
        return np.full(len(wanted), missing, np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, values[at], missing)


def vocabulary(counts: DataFrame, own_words: int = 1536, most_common: int = 1 << 18) -> Vocabulary:
    """The ``own_words`` commonest words (END is one of them) and the counts of at most ``most_common`` common ones."""
    end = int(np.uint64(END).view(np.int64))
    order = F.floor(F.log2("n") + 1e-9).cast("int").alias("order")
    sizes = counts.groupBy("rest", order).agg(F.count("*").alias("distinct"), F.sum("n").alias("n")).collect()  # at most 512 classes times 63 orders
    total, distinct = sum(r["n"] for r in sizes), sum(r["distinct"] for r in sizes)
    by_order, floor, kept = {}, 64, 0
    for r in sizes:
        by_order[r["order"]] = by_order.get(r["order"], 0) + r["distinct"]
    for i in sorted(by_order, reverse=True):
        kept += by_order[i]
        if kept > most_common or i < 2:
            break
        floor = i
    common = counts.filter(order >= floor).select("word", "n").toPandas().sort_values("word")
    top = counts.filter(F.col("word") != end).orderBy(F.desc("n"), "word").limit(own_words - 1).select("word", "rest", "n").collect()
    end_count = counts.filter(F.col("word") == end).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = np.array([end, *(r["word"] for r in top)], np.int64).view(np.uint64)
    rest_n, rest_distinct = np.zeros(REST_CLASSES, np.int64), np.zeros(REST_CLASSES, np.int64)
    for r in sizes:
        rest_n[r["rest"]] += r["n"]
        rest_distinct[r["rest"]] += r["distinct"]
    for r in top:
        rest_n[r["rest"]] -= r["n"]
        rest_distinct[r["rest"]] -= 1
    if end_count:
        rest_n[0] -= end_count
        rest_distinct[0] -= 1
    rank = np.argsort(own)
    known = common["word"].to_numpy(np.int64).view(np.uint64)
    by_word = np.argsort(known)
    class_counts = np.concatenate([[end_count], [r["n"] for r in top], rest_n]).astype(np.int64)
    return Vocabulary(total, distinct, own[rank], rank, known[by_word], common["n"].to_numpy(np.int64)[by_word], 1 << min(floor, 62), class_counts, np.log10(rest_n + rest_distinct + 1))


def encode(docs: DataFrame, key: str, text: str, known: Vocabulary, trained: Column) -> DataFrame:
    """Per row: ``row`` (a number of its own), key, trained, n_tokens, ``ids`` (classes), and what words count for.

    ``n_known`` and ``log_count`` (log10 of count and one) are over the common words, ``log_rest`` over those of them in
    rest classes, less the sizes of all words' rest classes. Words that are not common are left to be looked up: ``rare``
    with ``rare_n``, each once.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def encoded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        first = v.classes - REST_CLASSES
        row = TaskContext.get().partitionId() << 40
        for part in lean(parts):
            for a, b in batches(part.column(2)):
                every, rest, bounds = text_words(part.column(2).slice(a, b - a))
                ids = _lookup(v.own, v.order, every, -1)
                other = ids < 0
                ids[other] = first + rest[other]
                n = _lookup(v.common, v.counts, every, -1)
                log_count = np.log10(np.maximum(n, 0) + 1.0)
                log_rest = np.where(other, log_count - v.rest_size[rest], 0.0)
                text_of = np.repeat(np.arange(b - a), np.diff(bounds))
                sums = [np.bincount(text_of, weights, b - a) for weights in ((n > 0).astype(float), log_count, log_rest)]
                rare = n < 0
                pair = np.empty(int(rare.sum()), [("t", np.int64), ("w", np.uint64)])
                pair["t"], pair["w"] = text_of[rare], every[rare]
                pair, times = _distinct(pair)
                at = np.searchsorted(pair["t"], np.arange(b - a + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        pa.array(row + np.arange(b - a)), part.column(0).slice(a, b - a), part.column(1).slice(a, b - a), pa.array(np.diff(bounds)),
                        pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                        _binaries(ids.astype(np.uint16), bounds),
                        pa.ListArray.from_arrays(at, pair["w"].copy().view(np.int64)), pa.ListArray.from_arrays(at, times),
                    ],
                    ["row", "key", "trained", "n_tokens", "n_known", "log_count", "log_rest", "ids", "rare", "rare_n"],
                )
                row += b - a

    rows = docs.select(F.col(key), F.coalesce(trained, F.lit(False)), F.col(text))
    schema = f"row long, key {kind}, trained boolean, n_tokens long, n_known long, log_count double, log_rest double, ids binary, rare array<long>, rare_n array<long>"
    return rows.mapInArrow(encoded, schema)


def _distinct(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (text, word) in order, and how often each occurs."""
    pair = pair[np.lexsort((pair["w"], pair["t"]))]
    first = np.flatnonzero(np.concatenate([[True], (pair["t"][1:] != pair["t"][:-1]) | (pair["w"][1:] != pair["w"][:-1])])) if len(pair) else np.zeros(0, np.int64)
    return pair[first], np.diff(np.append(first, len(pair)))


def _binaries(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * ids.itemsize).astype(np.int32)), pa.py_buffer(ids.tobytes())])


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].copy().view(np.uint16).astype(np.int64), (bounds - bounds[0]) // 2


def contexts(ids: np.ndarray, bounds: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; ``start`` before the text."""
    one, two = np.full(len(ids), start), np.full(len(ids), start)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    heads = bounds[:-1][np.diff(bounds) > 0]
    one[heads] = two[heads] = start
    seconds = bounds[:-1][np.diff(bounds) > 1] + 1
    two[seconds] = start
    return one, two


class LogBilinear:
    """Vectors ``R`` of context classes (the last: start of text), ``Q`` and ``b`` of predicted ones, ``C`` of the places."""

    def __init__(self, class_counts: np.ndarray, size: int = 24, seed: int = 11):
        draw = np.random.default_rng(seed)
        n = len(class_counts)
        share = (class_counts + 1.0) / (class_counts.sum() + n)
        self.noise = share
        self.R = draw.normal(0, 0.3, (n + 1, size)).astype(np.float32)
        self.C = np.stack([np.eye(size, dtype=np.float32)] * 2) / 2
        self.Q = np.zeros((n, size), np.float32)
        self.b = np.log(share).astype(np.float32)

    def gradients(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, noise: np.ndarray) -> dict[str, np.ndarray]:
        """Ascent of the noise-contrastive log-likelihood per token; all tokens share the noise words.

        A token's word is held against as many noise words as are given: each is told from the other by
        ``score - log(k * noise share)``.
        """
        n, size = self.Q.shape
        r1, r2 = self.R[one], self.R[two]
        q = r1 @ self.C[0] + r2 @ self.C[1]
        log_noise = np.log(len(noise) * self.noise).astype(np.float32)
        true = (q * self.Q[w]).sum(axis=1) + self.b[w] - log_noise[w]
        false = q @ self.Q[noise].T + (self.b - log_noise)[noise]
        g = (1 / (1 + np.exp(np.clip(true, -30, 30)))).astype(np.float32) / len(w)
        f = -(1 / (1 + np.exp(-np.clip(false, -30, 30)))).astype(np.float32) / len(w)
        dq = g[:, None] * self.Q[w] + f @ self.Q[noise]
        dQ, db = _rows(w, g[:, None] * q, n), np.bincount(w, g, n)
        np.add.at(dQ, noise, f.T @ q)
        np.add.at(db, noise, f.sum(axis=0))
        dR = _rows(np.concatenate([one, two]), np.concatenate([dq @ self.C[0].T, dq @ self.C[1].T]), n + 1)
        return {"R": dR, "C": np.stack([r1.T @ dq, r2.T @ dq]), "Q": dQ, "b": db}

    def train(self, ids: np.ndarray, bounds: np.ndarray, noise_words: int, draw: np.random.Generator, squares: dict[str, np.ndarray], rate: float, batch: int = 1024) -> None:
        """Steps over all tokens in random order, each parameter's size set by the squares of its gradients so far."""
        one, two = contexts(ids, bounds, len(self.Q))
        order = draw.permutation(len(ids))
        cumulative = np.cumsum(self.noise)
        for at in np.array_split(order, max(1, len(order) // batch)):
            noise = np.minimum(np.searchsorted(cumulative, draw.random(noise_words)), len(self.Q) - 1)
            for name, gradient in self.gradients(ids[at], one[at], two[at], noise).items():
                squares[name] += gradient**2
                setattr(self, name, (getattr(self, name) + rate * gradient / np.sqrt(squares[name] + 1e-10)).astype(np.float32))

    def normalisers(self) -> np.ndarray:
        """Log of the summed scores of all classes for every pair of contexts: one product of two matrices."""
        one, two = (self.R @ c @ self.Q.T for c in self.C)
        one = one.astype(np.float64) + self.b
        high, other = one.max(axis=1), two.max(axis=1)
        total = np.exp(one - high[:, None]) @ np.exp(two.astype(np.float64) - other[:, None]).T
        return (np.log(np.maximum(total, 1e-300)) + high[:, None] + other).astype(np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of every class after every context, by place; the first with the bias."""
        return (self.R @ self.C[0] @ self.Q.T + self.b).astype(np.float32), (self.R @ self.C[1] @ self.Q.T).astype(np.float32)

    def stacked(self) -> np.ndarray:
        """All parameters as rows of one width."""
        wide = [np.hstack([x, np.zeros((len(x), 1))]) for x in (self.R, *self.C)]
        return np.vstack([*wide, np.hstack([self.Q, self.b[:, None]])])

    def unstack(self, rows: np.ndarray) -> None:
        n, size = self.Q.shape
        r, c1, c2, q = np.split(rows, [n + 1, n + 1 + size, n + 1 + 2 * size])
        self.R, self.C = r[:, :size].astype(np.float32), np.stack([c1[:, :size], c2[:, :size]]).astype(np.float32)
        self.Q, self.b = q[:, :size].astype(np.float32), q[:, size].astype(np.float32)


def _rows(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The rows of ``values`` added up by their numbers."""
    size = values.shape[1]
    return np.bincount((at[:, None] * size + np.arange(size)).ravel(), values.ravel(), n * size).reshape(n, size)


def fit_log_bilinear(encoded: DataFrame, known: Vocabulary, size: int = 24, folds: int = 3, noise_words: int = 48, rate: float = 0.1, least_words: int = 300_000) -> LogBilinear:
    """Train on all trained rows of ``encoded``, in ``folds`` rounds, each over its share of the rows.

    In a round every task starts from the same parameters, goes over its rows a million words at a time (over few words
    as often as makes ``least_words``), and passes on the rows of parameters that its words touched. They are averaged
    by how often they were. Without rows the model is the distribution of no words.
    """
    model = LogBilinear(known.class_counts, size)
    n = known.classes
    width = [f"x{i}" for i in range(size + 1)]
    for fold in range(folds):
        shared = encoded.sparkSession.sparkContext.broadcast((model, fold))

        def trained(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            base, fold = shared.value
            own = LogBilinear(known_counts, size)
            own.unstack(base.stacked())
            draw = np.random.default_rng([fold, TaskContext.get().partitionId()])
            squares = {"R": np.zeros((n + 1, size)), "C": np.zeros((2, size, size)), "Q": np.zeros((n, size)), "b": np.zeros(n)}
            touched = np.zeros(len(own.stacked()))
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def learn(passes: int) -> None:
                ids = np.concatenate([x for x, _ in held])
                bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in held]))])
                held.clear()
                for _ in range(passes):
                    own.train(ids, bounds, noise_words, draw, squares, rate)
                seen = np.bincount(ids, minlength=n)
                touched[:n] += seen
                touched[n] += 2 * (len(bounds) - 1)
                touched[n + 1 : n + 1 + 2 * size] += len(ids)
                touched[n + 1 + 2 * size :] += seen + len(ids) * own.noise / 16

            words_seen = 0
            for part in lean(parts):
                ids, bounds = _ids_of(part.column(0))
                words_seen += len(ids)
                held.append((ids, bounds))
                if sum(len(x) for x, _ in held) >= 1_000_000:
                    learn(1)
            if words_seen and held:
                learn(max(1, -(-least_words // words_seen)))
            at = np.flatnonzero(touched)
            rows = own.stacked()[at]
            yield pa.record_batch([pa.array(at), pa.array(touched[at]), *(pa.array(rows[:, i].astype(np.float64)) for i in range(size + 1))], ["place", "weight", *width])

        known_counts = known.class_counts
        rows = encoded.filter("trained").filter(F.pmod(F.xxhash64("row"), F.lit(folds)) == fold).select("ids")
        partial = rows.mapInArrow(trained, "place long, weight double, " + ", ".join(f"{x} double" for x in width))
        means = partial.groupBy("place").agg(*(F.expr(f"sum(weight * {x}) / sum(weight)").alias(x) for x in width)).toPandas()  # the parameters
        stacked = model.stacked()
        stacked[means["place"].to_numpy()] = means[width].to_numpy()
        model.unstack(stacked)
    return model


def class_scores(model: LogBilinear, encoded: DataFrame) -> DataFrame:
    """``row, log_class``: log10 of the probability of every row's classes."""
    shared = encoded.sparkSession.sparkContext.broadcast((model, model.normalisers()))

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, normaliser = shared.value
        after_one, after_two = model.tables()
        for part in lean(parts):
            ids, bounds = _ids_of(part.column(1))
            one, two = contexts(ids, bounds, len(model.Q))
            total = np.zeros(len(part))
            for a in range(0, len(ids), 1 << 20):  # a long text in pieces
                w, x, y = ids[a : a + (1 << 20)], one[a : a + (1 << 20)], two[a : a + (1 << 20)]
                text_of = np.searchsorted(bounds, np.arange(a, a + len(w)), side="right") - 1
                total += np.bincount(text_of, (after_one[x, w] + after_two[y, w] - normaliser[x, y]).astype(np.float64), len(part))
            yield pa.record_batch([part.column(0), pa.array(total / LN10)], ["row", "log_class"])

    return encoded.select("row", "ids").mapInArrow(scored, "row long, log_class double")


def score_texts(docs: DataFrame, trained: Column, key: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """Per row: key, ``trained``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model and all counts are learned from the rows where ``trained`` is true (null: not). ``score`` is the log10
    probability of the text: of every token's class, normalised over all classes, and for a word without a vector of its
    own ``(count + 1) / (class count + different words + 1)``, so that all unseen words of a class share one. A text ends
    with a token of its own; a null or empty one has only that. ``base_score`` is the same by counts alone, over one
    class. Rows that repeat a key are texts of their own; without training texts every word is unseen.
    """
    counts = written(word_counts(docs.filter(trained), text), "word-counts")
    known = vocabulary(counts)
    encoded = written(encode(docs, key, text, known, trained), "encoded")
    model = fit_log_bilinear(encoded, known, **settings)
    words_of = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("times"))
    seen = counts.filter(F.col("n") < known.least_common).select("word", "n")
    found = words_of.hint("merge").join(seen, "word").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_log"))
    rows = encoded.select("row", F.col("key").alias(key), "trained", "n_tokens", "n_known", "log_count", "log_rest")
    rows = rows.join(class_scores(model, encoded), "row").join(found, "row", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("more_known", "more_log")})
    base = F.col("log_count") + F.col("more_log") - F.col("n_tokens") * float(np.log10(known.total + known.distinct + 1))
    return rows.select(
        key, "trained", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("log_class") + F.col("log_rest") + F.col("more_log")).alias("score"),
    )
