"""The stored text index against the scan of all documents, and the blocks that it skips."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.operators import text_index
from pagemill.operators.retrieval import document_weights, tfidf_search
from pagemill.operators.terms import document_terms
from pagemill.operators.text_index import asked_terms, build_text_index, open_blocks, search_text
from pagemill.session import lookup_join, written

WORDS = X.whitespace_tokens


@pytest.fixture(scope="module")
def documents(spark):
    draw = random.Random(4)
    names = [f"w{i}" for i in range(300)]
    share = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(draw.choices(names, share, k=draw.randrange(5, 60)))) for i in range(900)]
    rows += [(2000, None), (2001, ""), (2002, "w0 " * 500), (2003, rows[5][1]), (None, "w1 w2")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def index(documents):
    return build_text_index(documents, "doc_id", WORDS(F.col("text")), parts=8, block_rows=32, head_terms=50)


@pytest.fixture(scope="module")
def queries(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(f"w{draw.randrange(300)}" for _ in range(draw.randrange(1, 7)))) for i in range(40)]
    rows += [(100, "w0"), (101, "unknown words"), (102, None), (103, "w299 w0 w0 unknown")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("k", [1, 4, 2000])
def test_rows_are_those_of_the_scan(documents, index, queries, k):
    words = WORDS(F.col("text"))
    got = search_text(index, queries, "item_id", words, k).select("query_id", "doc_id", "score", "rank").collect()
    want = tfidf_search(documents.filter("doc_id is not null"), "doc_id", words, queries, "item_id", words, k).select("query_id", "doc_id", "score", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_blocks_are_skipped(spark, index, queries):
    """Most of them for one term, where nothing else adds to a score; fewer the more terms a query has."""
    asked = written(asked_terms(index, queries, "item_id", WORDS(F.col("text"))), "asked")
    for rows, share in ((asked.filter("rest < 1e-9"), 0.5), (asked, 0.95)):
        every = index.blocks(spark, list(range(8))).join(rows, "term_no").count()
        assert 0 < open_blocks(index, rows, 1).count() < every * share


def test_blocks_are_bounded(spark, index):
    blocks = index.blocks(spark, list(range(8)))
    assert blocks.select(F.max(F.size("doc_ids"))).first()[0] <= 64
    assert blocks.filter("abs(top - array_max(weights)) > 1e-12 or array_min(weights) < top / 1.2").count() == 0


def test_only_parts_of_the_terms_are_read(spark, index):
    files = {r[0] for r in index.blocks(spark, [1, 6]).select(F.input_file_name()).distinct().collect()}
    assert files and all("part=1" in f or "part=6" in f for f in files)


def test_empty_tables(spark, documents, index, queries):
    words = WORDS(F.col("text"))
    assert search_text(index, queries.limit(0), "item_id", words, 3).collect() == []
    empty = build_text_index(documents.limit(0), "doc_id", words)
    assert search_text(empty, queries, "item_id", words, 3).collect() == []


def test_batches_of_queries_are_taken_in_chunks(documents, index, queries):
    words = WORDS(F.col("text"))
    rows = [search_text(index, queries, "item_id", words, 3, **chunks).collect() for chunks in ({}, {"batch_bytes": 2000})]
    assert sorted(map(tuple, rows[0])) == sorted(map(tuple, rows[1])) and rows[0]


def test_pairs_of_queries_and_documents_are_no_rows(spark, index, queries, monkeypatch):
    """What leaves the scoring is at most the best of each query and shard."""
    monkeypatch.setattr(text_index, "SCORE_ENTRIES", 4000)
    asked = written(asked_terms(index, queries, "item_id", WORDS(F.col("text"))), "asked")
    shards = -(-asked.select("term_no", "df").distinct().agg(F.sum("df")).first()[0] // 4000)
    every = asked.select("term_no", F.lit(0.0).alias("least_top")).distinct()
    most = text_index._scores(index, asked, every, 2).groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert shards > 1 and most <= 2 * shards


def test_rows_with_the_same_key_have_their_own_lengths(spark):
    """Rare terms go back to their row, not to all rows of its key."""
    rows = [(1, "a b c d"), (1, "a e"), (2, "a e f")]
    counted = document_terms(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", WORDS(F.col("text")))
    lexicon = spark.createDataFrame([(t, 2, 1.0, i) for i, t in enumerate("abcdef")], "term string, df long, idf double, term_no long")
    for head in (0, 1, 6):
        found = document_weights(counted, lexicon, head).collect()
        assert sorted((r.doc_id, round(r.length**2, 6), len(r.term_no), sum(r.df)) for r in found) == [(1, 2, 2, 4), (1, 4, 4, 8), (2, 3, 3, 6)]


def test_only_common_keys_are_copied(spark):
    """With a copy of every key for each salt this would be 2 * 10^8 rows."""
    table = spark.range(2000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    found = lookup_join(spark.range(1000, 3000).withColumnRenamed("id", "k"), table, "k", 0, 100_000, F.col("k") == 1500)
    assert found.count() == 1000 and found.filter("v != k * 2").count() == 0


def test_blocks_are_stored_in_pages(spark, index):
    """Most terms are rare, so a row for each of their blocks would cost more than its postings."""
    blocks = index.blocks(spark, list(range(8)))
    assert spark.read.parquet(f"{index.path}/blocks").count() * 10 < blocks.count()
    assert blocks.filter("size(doc_ids) = 0 or size(doc_ids) <> size(weights)").count() == 0


@pytest.mark.parametrize("run_tokens, page_entries", [(1, 7), (100, 1 << 16), (1 << 20, 64)])
def test_every_posting_is_stored_whatever_the_runs(spark, monkeypatch, run_tokens, page_entries):
    """Repeated keys, a word in every row, words of many bytes, rows and runs without words."""
    monkeypatch.setattr(text_index, "PAGE_ENTRIES", page_entries)
    draw = random.Random(6)
    words = ["the", "straße", "日本語", "🙂🙂", "x" * 300] + [f"w{i}" for i in range(200)]
    texts = [" ".join(["the"] + draw.choices(words, k=draw.randrange(40))) for _ in range(150)]
    rows = [(i % 140, t) for i, t in enumerate(texts)] + [(500, ""), (501, None), (None, "w1 w2"), (-3, "the the only")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    built = build_text_index(table, "doc_id", WORDS(F.col("text")), parts=4, block_rows=16, run_tokens=run_tokens)
    kept = [(doc, Counter((t or "").split())) for doc, t in rows if doc is not None]
    df = Counter(term for _, tf in kept for term in tf)
    want = []
    for doc, tf in kept:
        weights = {t: n * math.log((len(kept) + 1) / (df[t] + 1)) for t, n in tf.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        want += [(t, doc, round(w / length, 9)) for t, w in weights.items() if w > 0]
    terms = built.terms(spark)
    assert {(r.term, r.df, round(r.idf, 9)) for r in terms.collect()} == {(t, n, round(math.log((len(kept) + 1) / (n + 1)), 9)) for t, n in df.items()}
    postings = built.blocks(spark, list(range(4))).select("term_no", F.inline(F.arrays_zip("doc_ids", "weights"))).join(terms, "term_no")
    assert sorted((r.term, r.doc_ids, round(r.weights, 9)) for r in postings.collect()) == sorted(want)


def test_numbers_travel_as_bytes():
    values = np.array([5, -1, 1 << 40, 7, 8], dtype=np.int64)
    packed = text_index._packed(values, [0, 2, 2, 5])
    assert len(packed) == 3 and text_index._unpacked(packed, np.int64).tolist() == values.tolist()
    assert text_index._unpacked(packed.slice(1), np.int64).tolist() == [1 << 40, 7, 8]
    assert text_index._unpacked(pa.chunked_array([packed.slice(2), packed.slice(0, 1)]), np.int64).tolist() == [1 << 40, 7, 8, 5, -1]
    assert text_index._unpacked(packed.slice(0, 0), np.float64).tolist() == []


def test_a_block_is_picked_on_its_page(spark, tmp_path):
    """The first block of a page ends where the page says, however long the page before."""
    rows = [([1, 2], [0.5, 0.4], [1, 2], [10, 11], [0.5, 0.4], 0), ([3, 4], [0.9, 0.3], [4, 5], [20, 21, 22, 23, 24], [0.9, 0.8, 0.85, 0.84, 0.3], 0)]
    spark.createDataFrame(rows, text_index.PAGES).coalesce(1).write.partitionBy("part").parquet(f"{tmp_path}/index/blocks")
    index = text_index.TextIndex(f"{tmp_path}/index", 1)
    asked = spark.createDataFrame([(1, 3, 1.0, 4), (2, 4, 1.0, 1), (3, 2, 1.0, 1)], "query_id long, term_no long, weight double, df long")
    for least, want in ((0.0, [(1, 20, 0.9), (1, 22, 0.85), (2, 24, 0.3), (3, 11, 0.4)]), (0.4, [(1, 20, 0.9), (1, 22, 0.85), (3, 11, 0.4)])):
        found = text_index._scores(index, asked, asked.select("term_no", F.lit(least).alias("least_top")), 2)
        assert sorted(map(tuple, found.collect())) == want
    assert sorted(map(tuple, index.tops(spark, [0]).collect())) == [(1, 0.5), (2, 0.4), (3, 0.9), (4, 0.3)]
