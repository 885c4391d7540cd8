import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.functions import web
from pagemill.operators import retrieval as R
from pagemill.operators import terms as T
from pagemill.operators import topk
from pagemill.operators.tables import profile, random_rows, row_by_key
from pagemill.plans import features as E
from pagemill.session import lookup_join

TEXTS = ["a b a c", "b b d", "a", "", "e f g a b", "the cat and the dog is here"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_space_tokens(spark):
    row = spark.createDataFrame([("a  b\nc ",)], "t string").select(X.space_tokens(F.col("t")).alias("x")).first()
    assert row["x"] == ["a", "", "b\nc", ""]


def test_whitespace_tokens_split_as_python_does(spark):
    texts = ["a  b\nc ", " x y z\u0085w\x1fv　", "", "   ", "zero​width"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select(X.whitespace_tokens(F.col("t")).alias("x"))
    assert [r["x"] for r in rows.collect()] == [t.split() for t in texts] + [[]]


def test_decode_utf8(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é".encode()),)], "p binary")
    assert [tuple(r) for r in rows.select(web.decode_utf8(F.col("p")), web.decode_utf8(F.col("p"), "ignore")).collect()] == [("a�b", "ab"), ("é", "é")]
    assert spark.createDataFrame([("x",)], "p string").select(web.decode_utf8(F.col("p"))).first()[0] == "x"


def test_language(spark):
    rows = spark.createDataFrame([("The cat and the dog",), ("le chat et les chiens",), ("xyz",), (None,)], "t string")
    assert [r[0] for r in rows.select(X.guess_language(F.col("t"))).collect()] == ["en", "fr", None, None]


def test_term_counts(docs):
    rows = T.term_counts(docs, "doc_id", X.whitespace_tokens(F.col("text"))).collect()
    expected = {(i, w): n for i, t in enumerate(TEXTS) for w, n in Counter(t.split()).items()}
    assert {(r["doc_id"], r["term"]): r["tf"] for r in rows} == expected


def test_vocabulary_agrees_with_the_fitted_counts(docs):
    tokens = X.whitespace_tokens(F.col("text"))
    ours = {r["term"]: r["n"] for r in T.vocabulary(docs, tokens, 100).collect()}
    fitted = CountVectorizer(inputCol="w", outputCol="v", vocabSize=100).fit(docs.withColumn("w", tokens))
    assert set(fitted.vocabulary) == set(ours)
    assert [r["term"] for r in T.vocabulary(docs, tokens, 3).collect()] == ["a", "b", "the"]


def brute_force(texts, queries, k):
    df = Counter(w for t in texts for w in set(t.split()))
    idf = {w: math.log((len(texts) + 1) / (n + 1)) for w, n in df.items()}

    def vector(text):
        return {w: n * idf[w] for w, n in Counter(text.split()).items() if w in idf}

    def length(v):
        return math.sqrt(sum(x * x for x in v.values()))

    found = []
    for q, query in enumerate(queries):
        qv, scored = vector(query), []
        for d, text in enumerate(texts):
            dv = vector(text)
            dot = sum(w * dv.get(t, 0.0) for t, w in qv.items())
            if dot > 0:
                scored.append((-round(dot / length(qv) / length(dv), 6), d))
        found += [(q, d, -s) for s, d in sorted(scored)[:k]]
    return sorted(found)


@pytest.mark.parametrize("batch_bytes,head_terms", [(1 << 20, 1000), (1 << 20, 2), (1 << 20, 0), (300, 1000), (500, 3)])
def test_retrieval_equals_brute_force(spark, monkeypatch, batch_bytes, head_terms):
    monkeypatch.setattr(topk, "SCORE_CELLS", 30)
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(draw.choice(words, size=draw.integers(1, 20), p=None)) for _ in range(60)] + ["", "x" * 100 + " w1", "w1 w2", "w1 w2"]
    queries = ["w1 w2 w3", "w5", "unknown", "w7 w7 w8 " + "x" * 100, ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "d long, text string")
    asked = spark.createDataFrame(list(enumerate(queries)), "q long, text string")
    tokens = X.whitespace_tokens(F.col("text"))
    found = R.tfidf_search(documents, "d", tokens, asked, "q", tokens, 4, batch_bytes, head_terms).collect()
    assert sorted((r["query_id"], r["doc_id"], r["score"]) for r in found) == brute_force(texts, queries, 4)
    assert {r["rank"] for r in found} == {1, 2, 3, 4}


@pytest.mark.parametrize("most, calls", [(1 << 20, 1), (300, 30)])
def test_documents_are_scored_many_at_a_time(monkeypatch, most, calls):
    draw = np.random.default_rng(4)
    count = np.bincount
    seen = []
    monkeypatch.setattr(R, "PRODUCTS", most, raising=False)
    queries, documents = draw.random((7, 12)) * (draw.random((7, 12)) < 0.5), draw.random((400, 12)) * (draw.random((400, 12)) < 0.4)
    lengths = np.sqrt((documents * documents).sum(axis=1))
    (query, term), (doc, own) = queries.nonzero(), documents.nonzero()
    block, best = R.QueryBlock(query + 100, term * 3, queries[query, term]), topk.BestScores(7, 5)
    monkeypatch.setattr(np, "bincount", lambda *given: seen.append(1) or count(*given))
    block.score(best, np.arange(400), lengths, np.searchsorted(doc, np.arange(401)), own * 3, documents[doc, own])
    monkeypatch.undo()
    expected = np.round(queries @ documents.T / np.where(lengths == 0, 1, lengths), 6)
    assert len(seen) <= calls
    assert np.allclose(block.result(best).column("score").to_numpy().reshape(7, 5), -np.sort(-expected, axis=1)[:, :5], atol=1e-6)


def test_word2vec_is_the_mean_of_known_tokens(docs):
    content = docs.withColumnRenamed("text", "content")
    many = content.crossJoin(content.sparkSession.range(10)).select("doc_id", "content")
    first = E.feature_pipeline(min_count=5).fit(many.select("content"))
    again = E.feature_pipeline(min_count=5).fit(many.select("content"))
    vectors = {r["word"]: np.array(r["vector"]) for r in first.stages[1].getVectors().collect()}
    repeat = {r["word"]: np.array(r["vector"]) for r in again.stages[1].getVectors().collect()}
    assert all(np.allclose(vectors[w], repeat[w]) for w in vectors)
    rows = E.at_rest(E.transform_features(first, content)).collect()
    for row in rows:
        tokens = row["content"].split(" ")
        known = [vectors[t] for t in tokens if t in vectors]
        expected = np.sum(known, axis=0) / len(tokens) if known else np.zeros(E.VECTOR_SIZE)
        assert np.allclose(row["content_embedded"], expected)
        assert len(row["content_idf"]) == E.HASHED_FEATURES
    assert set(rows[0].asDict()) == {"doc_id", "content", "content_embedded", "content_idf"}


def test_null_content_has_features(spark, docs):
    often = docs.withColumnRenamed("text", "content").crossJoin(spark.range(5)).select("content")
    model = E.fit_features(often)
    row = E.at_rest(E.transform_features(model, spark.createDataFrame([(None,)], "content string"))).first()
    assert row["content"] is None and len(row["content_embedded"]) == 5 and len(row["content_idf"]) == 20


def test_hashed_idf(docs):
    rows = E.hashed_tfidf(docs, X.space_tokens(F.col("text"))).select(
        vector_to_array("raw_features").alias("tf"), vector_to_array("content_idf").alias("w")
    ).collect()
    tf = np.array([r["tf"] for r in rows])
    idf = np.log((len(rows) + 1) / ((tf > 0).sum(axis=0) + 1))
    assert np.allclose(np.array([r["w"] for r in rows]), tf * idf)


def test_random_rows_repeat(docs):
    first = [tuple(r) for r in random_rows(docs, "doc_id", 2, seed=1).collect()]
    assert first == [tuple(r) for r in random_rows(docs.repartition(3), "doc_id", 2, seed=1).orderBy("doc_id").collect()]
    assert len(first) == 2


def test_repeated_keys_come_with_all_their_rows(spark):
    rows = spark.createDataFrame([(i % 4, i) for i in range(12)], "k long, x long")
    found = random_rows(rows, "k", 2).collect()
    assert len({r["k"] for r in found}) == 2 and len(found) == 6


def _build_sides(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, [line for line in plan.split("\n") if "BroadcastHashJoin" in line]


def test_the_dictionary_is_broadcast_never_the_data(spark, docs):
    features, terms = T.vocabulary_tf(docs, X.whitespace_tokens(F.col("text")), 50)
    plan, joins = _build_sides(T.vector_terms(features, "doc_id", "raw_features", terms, "tf"))
    assert joins and all("BuildRight" in j for j in joins)
    rows, table = spark.range(1000).selectExpr("id % 3 as k", "id"), spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    plan, joins = _build_sides(lookup_join(rows, table, "k"))
    assert joins and all("BuildRight" in j for j in joins)
    salted = lookup_join(rows, table, "k", max_bytes=0, salts=4)
    assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
    assert salted.groupBy("v").count().orderBy("v").collect() == lookup_join(rows, table, "k").groupBy("v").count().orderBy("v").collect()
    assert salted.columns == ["k", "id", "v"]


def test_profile(spark):
    table = spark.createDataFrame([(1, None, [1]), (2, "b", None)], "a int, s string, l array<int>")
    rows = {r["column_name"]: r for r in profile(table).collect()}
    assert (rows["a"]["min_value"], rows["a"]["max_value"], rows["a"]["n_distinct_estimate"]) == ("1", "2", 2)
    assert rows["s"]["n_null"] == 1 and rows["l"]["n_null"] == 1 and rows["l"]["min_value"] is None


def test_row_by_key_is_pushed_down(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = row_by_key(pages, "page_id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(page_id,3)" in plan


def test_only_terms_of_the_queries_are_weighed(spark):
    counts = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (2, "x", 1)], "query_id long, term string, tf long")
    terms = spark.createDataFrame([("a", 1.0, 7), ("b", 2.0, 8)], "term string, idf double, term_no long")
    assert [tuple(r) for r in R.known_terms(counts, terms).collect()] == [("a", 1.0, 7)]
