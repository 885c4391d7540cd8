import numpy as np
import pyarrow as pa
import pytest
from samples import prose

from pagemill.llm.quality import FEATURES, PASSAGE_WORDS, AttentionModel, fit_quality, passages, quality_score


def test_passages_are_lines_cut_by_length():
    texts = pa.array(["a b\nc d", None, "", " \n ", " ".join(["w"] * (2 * PASSAGE_WORDS + 1)), "AB 12!"])
    x, at = passages(texts)
    assert list(np.diff(at)) == [2, 1, 1, 1, 3, 1] and x.shape == (9, FEATURES)
    assert not x[2:5].any() and np.allclose(x[8, : 65].sum(), 1)
    alone, _ = passages(texts.slice(5, 1))
    assert np.allclose(alone[0], x[8])


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(1)
    model = AttentionModel(features=6, encoded=5, gate=4)
    x, at, y, w = draw.normal(size=(9, 6)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        s = model._forward(x, at)[-1]
        return -np.mean(w * (y * np.log(s) + (1 - y) * np.log(1 - s)))

    for name, g in model._gradients(x, at, y, w).items():
        flat = model.weights[name].reshape(-1)
        for i in range(len(flat)):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = loss()
            flat[i] = kept - 1e-6
            down = loss()
            flat[i] = kept
            assert np.isclose((up - down) / 2e-6, g.reshape(-1)[i], atol=1e-5)


def test_one_bad_passage_among_good_ones_is_found():
    draw = np.random.default_rng(2)
    bags, label = [], []
    for i in range(240):
        bag = draw.normal(size=(draw.integers(2, 8), 5))
        bag[:, 0] = 0
        if i % 2:
            bag[draw.integers(len(bag)), 0] = 3
        bags.append(bag)
        label.append(1 - i % 2)
    x, at = np.concatenate(bags), np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = AttentionModel(features=5).fit(x, at, np.array(label, float))
    assert ((model.score(x, at) > 0.5) == np.array(label)).mean() > 0.97
    attention = model._forward(model._scaled(x), at)[3]
    assert np.mean([attention[a:b][x[a:b, 0] > 1].sum() * (b - a) for a, b, y in zip(at[:-1], at[1:], label) if not y]) > 1.2


def test_documents(frame, spark, odd_rows):
    good, bad = [(i, prose(i, 60)) for i in range(60)], [(100 + i, prose(i, 60).replace(" ", "$$$ ")) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good[:50] + bad[:50]] + [(None, 1, 0), (3, None, None), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(good + bad + [(i, t) for i, t, _ in odd_rows if i is None or i > 9])
    model = fit_quality(docs, labels)
    scores = docs.select("doc_id", quality_score(model, docs).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in scores)
    assert all((r["s"] >= 0.3) == (r["doc_id"] < 100) for r in scores if r["doc_id"] in {*range(50, 60), *range(150, 160)})
    again = fit_quality(docs.repartition(5), labels)
    assert all(np.allclose(model.weights[k], again.weights[k]) for k in model.weights)


def test_without_labels_every_score_is_one_half(frame, spark):
    docs = frame([(1, "a"), (2, None)])
    model = fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r[0] for r in docs.select(quality_score(model, docs)).collect()] == [0.5, 0.5]
    assert frame([]).select(quality_score(model, docs)).count() == 0


def test_held_out_accuracy(spark):
    from pagemill.llm.queries import catalogue

    got = catalogue.queries["op2_quality"](spark, "/root/testdata/sf0.01")
    rows = got.filter("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def test_labels_that_contradict_teach_nothing(frame, spark):
    docs = frame([(i, "good words, all fine. " * 3 if i % 2 else "x1 99 !! zz ## " * 3) for i in range(60)])
    sure = [(i, i % 2) for i in range(40)]
    model = fit_quality(docs, spark.createDataFrame(sure, "doc_id long, quality int"))
    both = [*sure, *sure[:5], *[(i, y) for i in range(40, 60) for y in (0, 1)], (None, 1), (3, None), (4, 7)]
    again = fit_quality(docs, spark.createDataFrame(both, "doc_id long, quality int"))
    assert all(np.allclose(model.weights[k], again.weights[k]) for k in model.weights)
