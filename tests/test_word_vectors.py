import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pagemill.operators import word_vectors as W
from pagemill.plans import features as E


@pytest.fixture(scope="module")
def texts(spark):
    """Words of two topics that never meet, rare ones among them, copies, and words that occur too seldom."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(1800):
        topic = "ab"[i % 2]
        words = [f"{topic}{n}" for n in draw.integers(0, 12, 30)] + [f"{topic}rare{i % 20}", f"once{i}"]
        rows.append(" ".join(draw.permutation(words)))
    rows += [rows[0]] * 3 + ["", "arare0", "a1 a1"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, content string").repartition(3).localCheckpoint()


def expected(rows, vectors):
    tokens = [r["content"].split(" ") for r in rows]
    return [np.sum([vectors[t] for t in ts if t in vectors], axis=0) / len(ts) + np.zeros(E.VECTOR_SIZE) for ts in tokens]


@pytest.mark.parametrize("head_words", [1000, 24, 7])
def test_every_word_is_known_however_small_the_head(texts, head_words):
    model = E.fit_features(texts, partitions=2, head_words=head_words)
    assert len(model.stages[1].head) == min(head_words, 44)  # what the driver holds
    vectors = {r["word"]: r["vector"].toArray() for r in model.stages[1].getVectors().collect()}
    counts = {r["w"]: r["count"] for r in texts.select(F.explode(F.split("content", " ")).alias("w")).groupBy("w").count().collect()}
    assert set(vectors) == {w for w, n in counts.items() if n >= 5}
    known = {r["doc_id"]: r["n_known"] for r in E.known_tokens(model, texts, "doc_id").collect()}
    rows = E.at_rest(E.transform_features(model, texts)).collect()
    assert known == {r["doc_id"]: sum(t in vectors for t in r["content"].split(" ")) for r in rows} and len(rows) == 1806
    assert np.allclose([r["content_embedded"] for r in rows], expected(rows, vectors))


@pytest.mark.parametrize("head_words", [1000, 24])
def test_words_of_a_topic_are_near_each_other(texts, head_words):
    found = E.fit_features(texts, partitions=2, head_words=head_words).stages[1].getVectors().collect()
    unit = {r["word"]: r["vector"].toArray() / np.linalg.norm(r["vector"].toArray()) for r in found}
    same = np.mean([unit[x] @ unit[y] for x in unit for y in unit if x[0] == y[0] and x != y])
    other = np.mean([unit[x] @ unit[y] for x in unit for y in unit if x[0] != y[0]])
    assert same > other + 0.2


def test_a_stored_model_is_the_same(texts, tmp_path):
    model = E.fit_features(texts, head_words=24)
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    one, two = ({r["doc_id"]: r["content_embedded"] for r in E.at_rest(E.transform_features(m, texts)).collect()} for m in (model, again))
    assert all(np.allclose(one[k], two[k]) for k in one)


def test_tokens_are_cut_once_a_side_and_stay_out_of_the_join(texts):
    model = E.fit_features(texts, partitions=2, head_words=24)
    plan = E.at_rest(E.transform_features(model, texts))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("MapInArrow") == 1
    joined = plan[: plan.index("Join LeftOuter")]
    assert "content_embedded" in joined and "content_tokenized" not in joined


def test_words_outside_the_head_are_rows_once_a_list(spark):
    lists = spark.createDataFrame([(["x", "a", "x", "y"],), (["a"],), ([],), (["x", "x", "y", "a"],), (["x", "y", "x"],)], "tokens array<string>")
    rows = W._others(lists.coalesce(1), W.pa.array(["a"])).collect()
    assert sorted((r["word"], r["n"]) for r in rows) == [("x", 2)] * 3 + [("y", 1)] * 3
    assert sum(r["lists"] for r in rows) == 3 and len({r["_key"] for r in rows}) == 2  # the first and the last list are alike


def test_contexts_are_the_head_words_on_both_sides():
    draw = np.random.default_rng(1)
    row, place = np.sort(draw.integers(0, 9, 200)) * 2, draw.integers(-1, 6, 200)
    vectors = draw.random((6, 3))
    sums, number = W.context_sums(row, place, vectors)
    for i in range(200):
        before = [p for p, r in zip(place[:i], row[:i]) if r == row[i] and p >= 0][-W.WINDOW :]
        after = [p for p, r in zip(place[i + 1 :], row[i + 1 :]) if r == row[i] and p >= 0][: W.WINDOW]
        assert number[i] == len(before + after)
        assert np.allclose(sums[i], vectors[before + after].sum(axis=0))
