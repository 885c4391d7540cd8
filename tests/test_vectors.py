import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import vectors as V
from pagemill.operators import nearest as N
from pagemill.operators import topk
from pagemill.operators.topk import BestScores


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(5)
    matrix = draw.normal(size=(40, 6))
    matrix[3] = 0.0
    matrix[11] = matrix[7]
    matrix[12] = matrix[7] * 2
    return matrix


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "id long, v array<double>")


def unit(m):
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def brute_force(items, queries, k, include_self=True):
    scores = np.round(unit(queries) @ unit(items).T, 6) + 0.0
    found = []
    for q in range(len(queries)):
        order = sorted((-scores[q, i], i) for i in range(len(items)) if include_self or i != q)
        found += [(q, i, -s) for s, i in order[:k]]
    return sorted(found)


def as_rows(df):
    return sorted((r["query_id"], r["item_id"], r["score"]) for r in df.collect())


def test_top_k_by_scan(table, data):
    found = N.top_k(table, "id", "v", table, "id", "v", k=5)
    assert as_rows(found) == brute_force(data, data, 5)


def test_top_k_by_chunks_of_queries(table, data):
    found = N.top_k(table, "id", "v", table, "id", "v", k=5, batch_bytes=300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert as_rows(found) == brute_force(data, data, 5)


def test_all_pairs(table, data):
    assert as_rows(N.all_pairs_top_k(table, "id", "v", 3)) == brute_force(data, data, 3, include_self=False)


def test_no_queries_no_rows(table):
    assert N.top_k(table, "id", "v", table.filter("id < 0"), "id", "v", k=5).count() == 0


def test_dot_matrix(table, data):
    rows = N.dot_matrix(table, "id", "v", table.filter("id < 4"), "id", "v").collect()
    assert np.allclose(np.array([r["scores"] for r in sorted(rows, key=lambda r: r["id"])]), data @ data[:4].T)


def test_dot_matrix_of_a_right_side_in_ranges(table, data):
    rows = N.dot_matrix(table, "id", "v", table, "id", "v", batch_bytes=300).collect()
    assert np.allclose(np.array([r["scores"] for r in sorted(rows, key=lambda r: r["id"])]), data @ data.T)


def test_shortlist_is_ranked_by_cosine(spark, table, data):
    coded = N.with_codes(table, "v")
    found = N.hamming_then_cosine(coded, "id", "v", N.first_vector(table, "id", "v"), shortlist=10, k=4).collect()
    distance = ((data > 0) != (data[0] > 0)).sum(axis=1)
    near = sorted(range(len(data)), key=lambda i: (distance[i], i))[:10]
    scores = np.round(unit(data) @ unit(data)[0], 6)
    order = sorted(near, key=lambda i: (-scores[i], i))[:4]
    assert [(r["id"], r["rank"]) for r in found] == [(i, n) for n, i in enumerate(order, 1)]


def test_similarity_to_first(table, data):
    rows = {r["id"]: r["score"] for r in N.similarity_to_first(table, "id", "v").collect()}
    expected = unit(data) @ unit(data)[0]
    assert len(rows) == 39 and all(abs(rows[i] - expected[i]) < 1e-5 for i in rows)
    assert rows[3] == 0.0


def test_columns(table, data):
    v = F.col("v")
    rows = table.select(
        "id", V.l2_normalize(v).alias("unit"), V.quantize_ubinary(v).alias("bits"), V.truncate(v, 2).alias("short"),
        V.sign_words(v).alias("words"),
    ).orderBy("id").collect()
    assert np.allclose(np.array([r["unit"] for r in rows]), unit(data))
    assert [r["bits"] for r in rows] == [list(np.packbits(row > 0)) for row in data]
    assert [r["short"] for r in rows] == [list(row[:2]) for row in data]


def test_wide_codes(spark):
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=150), draw.normal(size=150)
    row = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b])], "a array<double>, b array<double>").select(
        V.hamming(V.sign_words(F.col("a")), V.sign_words(F.col("b"))).alias("d"), V.quantize_ubinary(F.col("a")).alias("bits")
    ).first()
    assert row["d"] == int(((a > 0) != (b > 0)).sum())
    assert row["bits"] == list(np.packbits(a > 0))


def test_sparse_entries(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.sparse(5, {1: 2.0, 4: 3.0}),)], ["v"])
    assert rows.select(V.sparse_entries(F.col("v")).alias("e")).first()["e"] == [(1, 2.0), (4, 3.0)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), max_size=30), st.integers(1, 4), st.integers(1, 9))
def test_best_scores_keeps_the_best(columns, k, step):
    scores = np.array(columns, dtype=float).reshape(-1, 3).T
    items = np.arange(scores.shape[1])[::-1].copy()
    best = BestScores(3, k)
    for start in range(0, scores.shape[1], step):
        best.add(scores[:, start:start + step], items[start:start + step])
    query, item, score = best.rows()
    found = sorted(zip(query.tolist(), item.tolist(), score.tolist()))
    expected = []
    for q in range(3):
        order = sorted(zip(-scores[q], items))[:k]
        expected += [(q, int(i), -s + 0.0) for s, i in order]
    assert found == sorted(expected)


def test_tasks_of_all_pairs_are_bounded(spark, monkeypatch):
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.integers(-2, 3, 4)]) for i in range(120)]
    vectors = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    whole = N.all_pairs_top_k(vectors, "id", "v", 3).collect()
    monkeypatch.setattr(N, "TASK_PAIRS", 1200)
    dealt = []
    scan = N._scan
    monkeypatch.setattr(N, "_scan", lambda items, *more: dealt.append(items.rdd.getNumPartitions()) or scan(items, *more))
    assert sorted(N.all_pairs_top_k(vectors, "id", "v", 3).collect()) == sorted(whole)
    assert dealt == [12]


def test_best_scores_by_few_candidates():
    draw = np.random.default_rng(9)
    scores = np.round(draw.normal(size=(7, 400)), 2) + draw.choice([0, 4e-7, -4e-7], size=(7, 400))
    scores[2], scores[3, :390] = -np.inf, -np.inf
    items = draw.permutation(400)
    best = topk.BestScores(7, 4)
    for start in range(0, 400, 25):
        best.add(scores[:, start : start + 25], items[start : start + 25])
    found = {(q, i, s) for q, i, s in zip(*best.rows())}
    order = [sorted((-round(s, 6), i) for s, i in zip(line, items) if np.isfinite(s))[:4] for line in scores]
    assert found == {(q, i, -s) for q, line in enumerate(order) for s, i in line}
