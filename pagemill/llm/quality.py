"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages (lines, cut every ``PASSAGE_WORDS`` words). Every passage is encoded, gated attention weighs the
passages of a bag, and the weighted mean of the encodings is scored. Only texts have labels; the weights of passages
are learned from them. Features come from whole Arrow batches in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.language import training_rows
from pagemill.llm.words import batches, buffers, lean, words

PASSAGE_WORDS = 48
#: Every ASCII mark and digit is a class of its own; so are capitals, small letters, white space and all beyond ASCII.
CLASS = np.array([i if 33 <= i < 65 else 0 if i < 33 else 1 if i < 91 else 2 if i < 97 else 3 if i < 123 else i - 119 if i < 128 else 9 for i in range(256)])
CLASSES = 65
HASHED = 64
FEATURES = CLASSES + HASHED + 5


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and where each text's passages begin (with the end of the last).

    A text without words is one passage of zeros.
    """
    raw, bounds = buffers(texts)
    hashes, starts, ends, at = words(texts)
    counts = np.diff(at)
    text_of = np.repeat(np.arange(len(counts)), counts)
    line = np.concatenate([[0], np.cumsum(raw == 10)])[starts]
    n = len(hashes)
    opens = np.ones(n, bool)
    opens[1:] = (line[1:] != line[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    opens |= (np.arange(n) - first) % PASSAGE_WORDS == 0
    head = np.flatnonzero(opens)
    passage = np.cumsum(opens) - 1
    size = np.diff(np.append(head, n))
    out = np.zeros((len(head), FEATURES), np.float32)
    if n:
        owner = np.searchsorted(starts[head], np.arange(len(raw)), side="right") - 1
        own = owner >= 0
        classes = np.bincount(owner[own] * CLASSES + CLASS[raw[own]], minlength=len(head) * CLASSES).reshape(-1, CLASSES)
        out[:, :CLASSES] = classes / np.maximum(classes.sum(axis=1, keepdims=True), 1)
        hashed = np.bincount(passage * HASHED + (hashes >> np.uint64(58)).astype(np.int64), minlength=len(head) * HASHED).reshape(-1, HASHED)
        out[:, CLASSES : CLASSES + HASHED] = hashed / size[:, None]
        repeated = np.zeros(n)
        repeated[1:] = (hashes[1:] == hashes[:-1]) & ~opens[1:]
        value = np.add.reduceat(hashes * (np.arange(n) - head[passage] + 1).astype(np.uint64), head)
        again = pd.Series(value).groupby([text_of[head], value]).transform("size").to_numpy()
        out[:, -5] = np.add.reduceat(ends - starts, head) / size / 10
        out[:, -4] = np.add.reduceat(repeated, head) / size
        out[:, -3] = np.log(size)
        out[:, -2] = np.log(again)
        out[:, -1] = np.log(counts[text_of[head]]) / 4
    many = np.bincount(text_of[head], minlength=len(counts))
    empty = np.flatnonzero(many == 0)
    out = np.insert(out, np.concatenate([[0], np.cumsum(many)])[empty], 0, axis=0)
    return out, np.concatenate([[0], np.cumsum(np.maximum(many, 1))])


class AttentionModel:
    """Gated attention over encoded passages. ``fit`` and ``score`` work on all bags of an array at once."""

    def __init__(self, features: int = FEATURES, encoded: int = 24, gate: int = 12, seed: int = 7):
        self.draw = np.random.default_rng(seed)
        sizes = {"E": (features, encoded), "V": (encoded, gate), "U": (encoded, gate), "w": (gate, 1), "o": (encoded, 1)}
        self.weights = {k: self.draw.normal(0, 1 / np.sqrt(a), (a, b)) for k, (a, b) in sizes.items()} | {"e": np.zeros(encoded), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(features), np.ones(features)

    def _forward(self, x: np.ndarray, at: np.ndarray) -> tuple:
        p, heads, many = self.weights, at[:-1], np.diff(at)
        h = np.tanh(x @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
        raw = ((t * s) @ p["w"])[:, 0]
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, heads), many))
        a = raw / np.repeat(np.add.reduceat(raw, heads), many)
        z = np.add.reduceat(h * a[:, None], heads)
        return h, t, s, a, z, 1 / (1 + np.exp(-np.clip((z @ p["o"])[:, 0] + p["b"], -30, 30)))

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._forward(self._scaled(x), at)[-1] if len(at) > 1 else np.zeros(0)

    def fit(self, x: np.ndarray, at: np.ndarray, label: np.ndarray, rounds: int = 250, rate: float = 0.01, decay: float = 1e-3) -> AttentionModel:
        """Adam over batches of 256 bags, by the log loss; both labels weigh the same."""
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        x = self._scaled(x)
        balance = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9)) if 0 < label.mean() < 1 else np.ones(len(label))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.weights.items()}
        step = 0
        for _ in range(max(rounds * 256 // max(len(label), 256), 20)):
            order = self.draw.permutation(len(label))
            for part in np.array_split(order, max(1, len(order) // 256)):
                rows = np.concatenate([np.arange(at[i], at[i + 1]) for i in part])
                own = np.concatenate([[0], np.cumsum(at[part + 1] - at[part])])
                step += 1
                for k, g in self._gradients(x[rows], own, label[part], balance[part]).items():
                    g = g + decay * self.weights[k]
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.weights[k] = self.weights[k] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, at: np.ndarray, label: np.ndarray, balance: np.ndarray) -> dict[str, np.ndarray]:
        p, heads, many = self.weights, at[:-1], np.diff(at)
        h, t, s, a, z, score = self._forward(x, at)
        d = ((score - label) * balance / len(label))[:, None]
        dz = np.repeat(d @ p["o"].T, many, axis=0)
        da = (dz * h).sum(axis=1)
        draw = (a * (da - np.repeat(np.add.reduceat(a * da, heads), many)))[:, None]
        dgate = draw @ p["w"].T
        dt, ds = dgate * s * (1 - t * t), dgate * t * s * (1 - s)
        dh = (dz * a[:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"o": z.T @ d, "b": d.sum(axis=0), "w": (t * s).T @ draw, "V": h.T @ dt, "U": h.T @ ds, "E": x.T @ dh, "e": dh.sum(axis=0)}


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", texts_per_label: int = 1500) -> AttentionModel:
    """Learn from a sample of at most about ``texts_per_label`` whole texts of either label (0, 1); other rows teach nothing.

    A key that is labelled both ways teaches nothing, one labelled twice alike counts once. Without any labelled text every score is one half.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    known = known.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("most")).filter("y = most").drop("most")
    sample = training_rows(known, "k", "y", texts_per_label)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(sample), "k")  # bounded by the sample

    def features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(2)):
                x, at = passages(part.column(2).slice(a, b - a))
                rows = [x[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                yield pa.record_batch([part.column(0).slice(a, b - a), part.column(1).slice(a, b - a), pa.array(rows, pa.binary())], ["k", "y", "x"])

    table = rows.select("k", "y", "t").mapInArrow(features, "k long, y int, x binary").toPandas().sort_values(["k", "x"])
    model = AttentionModel()
    if not len(table):
        model.weights["o"][:] = 0
        return model
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in table["x"]]
    return model.fit(np.concatenate(bags).astype(float), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), table["y"].to_numpy(float))


def quality_score(model: AttentionModel, docs: DataFrame, text: str = "text") -> Column:
    """Score of every text, 0 to 1, higher for texts like those of label 1; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in lean(parts):
            texts = pa.array(part, pa.large_string(), from_pandas=True)
            scores = [shared.value.score(*passages(texts.slice(a, b - a))) for a, b in batches(texts)]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    return scored(F.col(text))
