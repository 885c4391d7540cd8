"""Cells of vectors and parts of codes against scans of everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import cells as C
from pagemill.operators import code_index as H
from pagemill.operators import nearest as N
from pagemill.session import written

EMBEDDINGS = "/root/testdata/sf0.01/embeddings.parquet"


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(EMBEDDINGS)


@pytest.fixture(scope="module")
def index(vectors):
    return C.build_cells(vectors, "vec_id", "embedding", 16, block_rows=20)


def grouped(spark, n=600, groups=20):
    draw = np.random.default_rng(3)
    middle = draw.normal(0, 1, (groups, 32))
    rows = [(i, (middle[i % groups] + draw.normal(0, 0.15, 32)).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def exact(vectors, queries, k, include_self=True):
    return sorted(map(tuple, N.top_k(vectors, "vec_id", "embedding", queries, "vec_id", "embedding", k, include_self).select("query_id", "item_id", "score", "rank").collect()))


def rows_of(found):
    return sorted(map(tuple, found.select("query_id", "item_id", "score", "rank").collect()))


def test_every_vector_is_in_one_cell(spark, vectors, index):
    stored = C.blocks_of(index, spark, list(range(16))).select("cell", F.explode("ids").alias("id"))
    assert sorted(r["id"] for r in stored.collect()) == sorted(r["vec_id"] for r in vectors.select("vec_id").collect())
    assert {r["cell"]: r["count"] for r in stored.groupBy("cell").count().collect()} == {i: int(n) for i, n in enumerate(index.sizes) if n}


def test_blocks_are_bounded(spark, index):
    sizes = [r[0] for r in C.blocks_of(index, spark, list(range(16))).select(F.size("ids")).collect()]
    assert max(sizes) <= 40 and len(sizes) > 16  # dealt by a hash into blocks of about 20


def test_exact_search_is_the_scan(vectors, index):
    queries = vectors.filter("vec_id % 25 = 0")
    for probes in (1, 5):
        assert rows_of(C.search_cells(index, queries, "vec_id", "embedding", 10, probes, exact=True)) == exact(vectors, queries, 10)
    assert rows_of(C.search_cells(index, queries, "vec_id", "embedding", 3, 2, exact=True, include_self=False, chunk_rows=3)) == exact(vectors, queries, 3, False)


def test_recall_at_ten_of_probed_cells(vectors, index):
    queries = vectors.filter("vec_id % 3 = 0")
    truth = {r[:2] for r in exact(vectors, queries, 10)}
    probes = C.probes_for_recall(index, vectors.filter("vec_id % 3 = 1"), "vec_id", "embedding", 10, 0.95)
    found = {r[:2] for r in rows_of(C.search_cells(index, queries, "vec_id", "embedding", 10, probes))}
    assert probes < 16
    assert len(found & truth) / len(truth) >= 0.9


def test_vectors_in_groups_need_few_cells(spark):
    vectors = grouped(spark)
    index = C.build_cells(vectors, "vec_id", "embedding", 20)
    queries = vectors.filter("vec_id % 10 = 0")
    assert C.probes_for_recall(index, queries, "vec_id", "embedding", 10, 0.95) <= 3
    open_cells = C._probed(index, written(queries.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), F.lit(0.9).alias("least")), "q"), 1, rest=True)
    assert open_cells.count() < 60 * 19 / 2  # most cells are ruled out by their reach


def test_only_probed_cells_are_read(spark, index):
    plan = C.blocks_of(index, spark, [3, 5])._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and "cell#" in plan
    files = C.blocks_of(index, spark, [3, 5]).select(F.input_file_name()).distinct().collect()
    assert files and all("cell=3" in r[0] or "cell=5" in r[0] for r in files)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], "x"), (2, [0.0, 0.0], "x"), (3, None, "x"), (4, [1.0, 0.0], "x"), (4, [1.0, 0.0], "x"), (5, [-1.0, 0.1], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")
    index = C.build_cells(vectors, "vec_id", "embedding", 4)
    queries = vectors.filter("vec_id in (1, 2, 3)")
    assert rows_of(C.search_cells(index, queries, "vec_id", "embedding", 4, 1, exact=True)) == exact(vectors.filter("embedding is not null"), queries.filter("embedding is not null"), 4)


def test_empty_tables(spark, vectors, index):
    none = vectors.filter("vec_id < 0")
    assert C.search_cells(index, none, "vec_id", "embedding", 5, 2, exact=True).collect() == []
    empty = C.build_cells(none, "vec_id", "embedding", 4)
    assert C.search_cells(empty, vectors, "vec_id", "embedding", 5, 2).collect() == []
    assert C.probes_for_recall(empty, vectors, "vec_id", "embedding", 5, 0.9) == 1


def plain_pairs(rows, queries, radius):
    flips = lambda a, b: sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a, b))
    return sorted((q, i, flips(a, b)) for q, a in queries for i, b in rows if flips(a, b) <= radius)


@pytest.mark.parametrize("words,parts,radius", [(1, 4, 5), (1, 4, 0), (1, 4, 2), (2, 4, 9), (1, 3, 7), (2, 2, 3), (1, 8, 20)])
def test_neighbours_are_those_of_a_scan(spark, words, parts, radius):
    draw = np.random.default_rng(words * 100 + radius)
    base = draw.integers(-(2**63), 2**63, (6, words))
    rows = []
    for i in range(240):
        code = base[i % 6].copy()
        for bit in draw.choice(64 * words, draw.integers(0, radius + 4), replace=False):
            code[bit // 64] ^= np.int64(np.uint64(1 << int(bit % 64)).view(np.int64))
        rows.append((i, code.tolist()))
    table = spark.createDataFrame(rows, "id long, code array<long>")
    index = H.code_index(table, "id", "code", words, parts)
    found = H.within_radius(index, table.filter("id % 12 = 0"), "id", "code", radius, words, parts)
    assert sorted(map(tuple, found.collect())) == plain_pairs(rows, rows[::12], radius)


def test_a_value_of_most_codes(spark):
    """All codes share three parts; pairs come once, and null or short codes are left out."""
    rows = [(i, [i % 5]) for i in range(200)] + [(900, None), (901, []), (902, [1, 2])]
    table = spark.createDataFrame(rows, "id long, code array<long>")
    index = H.code_index(table, "id", "code", 1)
    found = H.within_radius(index, table.filter("id in (0, 1, 900, 901)"), "id", "code", 1, 1)
    assert sorted(map(tuple, found.collect())) == plain_pairs(rows[:200], rows[:2], 1)


def test_shares_add_up():
    for radius in range(40):
        for parts in range(1, 9):
            assert sum(s + 1 for s in H.shares(radius, parts)) == radius + 1


@pytest.mark.parametrize("batch_bytes", [1, 60, 1 << 20])
def test_matrix_in_blocks(spark, batch_bytes):
    draw = np.random.default_rng(9)
    left = [(i if i % 4 else None, draw.normal(0, 1, 3).tolist()) for i in range(23)] + [(1, [1.0, 2.0, 3.0]), (50, None)]
    right = [(i if i % 3 else None, draw.normal(0, 1, 3).tolist()) for i in range(12)] + [(60, None)]
    schema = "k long, v array<double>"
    got = N.dot_matrix(spark.createDataFrame(left, schema), "k", "v", spark.createDataFrame(right, schema), "k", "v", batch_bytes, block_rows=5)
    ordered = sorted((k is not None, k or 0, v) for k, v in right if v)
    want = sorted((str(k), [round(float(np.dot(v, w)), 9) for _, _, w in ordered]) for k, v in left if v)
    assert sorted((str(r["k"]), [round(x, 9) for x in r["scores"]]) for r in got.collect()) == want


def test_matrix_with_nothing(spark):
    some = spark.createDataFrame([(1, [1.0])], "k long, v array<double>")
    none = some.filter("k > 1")
    assert [tuple(r) for r in N.dot_matrix(some, "k", "v", none, "k", "v").collect()] == [(1, [])]
    assert N.dot_matrix(none, "k", "v", some, "k", "v").collect() == []
