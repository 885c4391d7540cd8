"""The language model against plain loops: counts, probabilities, gradients, and what it learns."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import prose

from pagemill.llm.log_bilinear import END, REST_CLASSES, LogBilinear, contexts, encode, fit_log_bilinear, score_texts, text_words, vocabulary, word_counts


def trained():
    return F.crc32(F.col("doc_id").cast("string")) % 7 != 2


def tokens(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def in_training(key):
    import zlib

    return key is not None and zlib.crc32(str(key).encode()) % 7 != 2


def base(rows):
    counts = Counter(t for k, x in rows if in_training(k) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    return [(k, in_training(k), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x))) for k, x in rows]


def same_base(docs, rows, **settings):
    got = score_texts(docs, trained(), **settings).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r) for r in got), key=order), sorted(base(rows), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], abs=1e-6)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)
    return got


def test_base_of_odd_rows(frame, odd_rows):
    rows = [r[:2] for r in odd_rows] + [(1000 + i, prose(i, 40)) for i in range(60)]
    same_base(frame(rows), rows, folds=1, least_words=1000)


def test_without_training_rows(frame):
    rows = [(None, "some words"), (None, None)]
    same_base(frame(rows), rows)


def test_empty_table(frame):
    assert score_texts(frame([]), trained()).collect() == []


def test_rest_classes_are_of_the_first_two_bytes():
    every, rest, bounds = text_words(pa.array(["Abc abd x", None, "", "é ABX"]))
    assert every[[3, 4, 5, 8]].tolist() == [END] * 4 and bounds.tolist() == [0, 4, 5, 6, 9]
    assert rest[0] == rest[1] == rest[7] != rest[2] and rest[[3, 4, 5, 8]].tolist() == [0] * 4


def test_contexts_stay_within_a_text():
    one, two = contexts(np.array([5, 6, 7, 8, 9, 5]), np.array([0, 3, 3, 4, 6]), 99)
    assert one.tolist() == [99, 5, 6, 99, 99, 9] and two.tolist() == [99, 99, 5, 99, 99, 99]


def small(seed=0, n=7, size=4):
    model = LogBilinear(np.arange(1, n + 1), size)
    draw = np.random.default_rng(seed)
    model.Q = draw.normal(0, 1, model.Q.shape)
    model.R, model.C, model.b = model.R.astype(float), model.C.astype(float), model.b.astype(float)
    return model


def test_probabilities_add_up_to_one():
    model = small()
    n = len(model.Q)
    one, two = model.tables()
    normaliser = model.normalisers()
    for x in range(n + 1):
        for y in range(n + 1):
            scores = [sum((model.R[x] @ model.C[0] + model.R[y] @ model.C[1]) * model.Q[w]) + model.b[w] for w in range(n)]
            assert normaliser[x, y] == pytest.approx(math.log(sum(map(math.exp, scores))), abs=1e-4)
            assert np.exp(one[x] + two[y] - normaliser[x, y]).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_those_of_the_likelihood():
    model = small(1)
    draw = np.random.default_rng(2)
    w, one, two, noise = draw.integers(0, 7, 9), draw.integers(0, 8, 9), draw.integers(0, 8, 9), draw.integers(0, 7, 5)

    def likelihood():
        total = 0.0
        for i in range(9):
            q = model.R[one[i]] @ model.C[0] + model.R[two[i]] @ model.C[1]
            gap = lambda j: q @ model.Q[j] + model.b[j] - math.log(5 * model.noise[j])
            total += math.log(1 / (1 + math.exp(-gap(w[i])))) + sum(math.log(1 - 1 / (1 + math.exp(-gap(j)))) for j in noise)
        return total / 9

    for name, gradient in model.gradients(w, one, two, noise).items():
        values = getattr(model, name)
        for place in list(np.ndindex(values.shape))[::3]:
            kept, step = values[place], 1e-4
            values[place] = kept + step
            up = likelihood()
            values[place] = kept - step
            down = likelihood()
            values[place] = kept
            assert gradient[place] == pytest.approx((up - down) / (2 * step), abs=2e-4)


def test_score_is_the_product_of_its_parts(frame):
    """Every token of every text by a plain loop over the fitted model."""
    rows = [(i, prose(i, 30) + " odd" + "x" * (i % 5)) for i in range(80)]
    docs = frame(rows)
    counts = word_counts(docs.filter(trained())).cache()
    known = vocabulary(counts, own_words=20, most_common=50)
    model = fit_log_bilinear(encode(docs, "doc_id", "text", known, trained()), known, folds=1, least_words=2000)
    from pagemill.llm.log_bilinear import class_scores

    encoded = encode(docs, "doc_id", "text", known, trained())
    got = {r["key"]: r["log_class"] for r in encoded.select("row", "key").join(class_scores(model, encoded), "row").collect()}
    for key, text in rows[:12]:
        every, rest, bounds = text_words(pa.array([text]))
        own = dict(zip(known.own.tolist(), known.order.tolist()))
        ids = [own.get(int(x), 20 + int(c)) for x, c in zip(every, rest)]
        past, total = [len(model.Q)] * 2 + ids, 0.0
        for i, w in enumerate(ids):
            scores = model.Q @ (model.R[past[i + 1]] @ model.C[0] + model.R[past[i]] @ model.C[1]) + model.b
            total += math.log10(np.exp(scores[w]) / np.exp(scores).sum())
        assert got[key] == pytest.approx(total, abs=1e-2)
    assert known.classes == 20 + REST_CLASSES
    counts.unpersist()


def test_order_of_words_is_learned(frame):
    """Texts of alternating words: held-out texts get more than by counts, shuffled ones less."""
    draw = random.Random(5)

    def text(i):
        return " ".join(f"{'ab'[(i + j) % 2]}{draw.randrange(20)}" for j in range(60))

    rows = [(i, text(i)) for i in range(400)]
    shuffled = [(10_000 + i, " ".join(draw.sample(t.split(), 60))) for i, t in rows[:40]]
    got = {r["doc_id"]: r for r in score_texts(frame(rows + shuffled), trained() & (F.col("doc_id") < 10_000)).collect()}
    held = [i for i, _ in rows if not in_training(i)]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held) + 0.1 * 61 * len(held)
    assert np.mean([got[i]["score"] for i, _ in shuffled]) < np.mean([got[i]["score"] for i in held])
