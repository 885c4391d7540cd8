"""Vector queries on the ``embeddings`` table; batches of queries are the unit mean vectors of the labels."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from pagemill.functions import vectors as V
from pagemill.operators import cells as C
from pagemill.operators import code_index as H
from pagemill.operators import nearest as N
from pagemill.session import written
from workload import Catalogue, spread_table

catalogue = Catalogue()

DOUBLES = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
FIRST = "f AS (SELECT vec_id AS first_id, v AS q FROM e ORDER BY vec_id LIMIT 1)"
MEANS = """
    spread AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS pos FROM e),
    means AS (SELECT label, pos, avg(x) AS x FROM spread GROUP BY label, pos),
    m AS (SELECT label, list(x ORDER BY pos) AS q FROM means GROUP BY label)
"""


def embeddings(spark, sf_dir):
    return spread_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")


def label_means(spark, sf_dir):
    mean = vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("q")
    return embeddings(spark, sf_dir).filter("label IS NOT NULL").groupBy("label").agg(mean)


@catalogue.query(f"""
    WITH {DOUBLES}, {FIRST}
    SELECT vec_id, round(list_cosine_similarity(q, v), 6) AS score FROM e, f WHERE vec_id <> first_id
""")
def cosine_to_first(spark, sf_dir):
    return N.similarity_to_first(embeddings(spark, sf_dir), "vec_id", "embedding")


@catalogue.query(f"""
    WITH {DOUBLES}, {FIRST}
    SELECT vec_id, len(v[1:32]) AS dims, round(list_cosine_similarity(q[1:32], v[1:32]), 6) AS score
    FROM e, f WHERE vec_id <> first_id
""")
def truncated_cosine(spark, sf_dir):
    short = embeddings(spark, sf_dir).select("vec_id", V.truncate(F.col("embedding"), 32).alias("v"))
    scored = N.similarity_to_first(short, "vec_id", "v", F.size("v").cast("bigint").alias("dims"))
    return scored.select("vec_id", "dims", "score")


@catalogue.query(f"""
    WITH {DOUBLES}, n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM e)
    SELECT vec_id, unnest(range(len(v))) AS pos, round(unnest(list_transform(v, lambda x: x / len)), 6) AS x FROM n
""")
def l2_normalized(spark, sf_dir):
    unit = V.l2_normalize(F.col("embedding"))
    rows = embeddings(spark, sf_dir).select("vec_id", F.posexplode(unit).alias("pos", "x"))
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


BITS = "list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END)"
BYTES = (
    "list_transform(range(8), lambda g: list_sum(list_transform(range(8), lambda i: b[g * 8 + i + 1] * (1 << (7 - i)))))"
)


@catalogue.query(f"""
    WITH b AS (SELECT vec_id, {BITS} AS b FROM embeddings)
    SELECT vec_id, array_to_string(list_transform({BYTES}, lambda x: CAST(x AS BIGINT)), ' ') AS code FROM b
""")
def binary_codes(spark, sf_dir):
    code = V.quantize_ubinary(F.col("embedding"))
    return embeddings(spark, sf_dir).select("vec_id", F.array_join(code.cast("array<string>"), " ").alias("code"))


@catalogue.query(f"""
    WITH {DOUBLES}, {FIRST},
    d AS (SELECT vec_id, list_sum(list_transform(range(1, len(v) + 1), lambda i: CASE WHEN (v[i] > 0) <> (q[i] > 0) THEN 1 ELSE 0 END)) AS d,
                 round(list_cosine_similarity(q, v), 6) AS score FROM e, f)
    SELECT vec_id, CAST(d AS INTEGER) AS distance, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank
    FROM (SELECT * FROM d ORDER BY d, vec_id LIMIT 20)
""")
def hamming_shortlist(spark, sf_dir):
    """The 20 codes nearest to the first vector's, ranked by cosine."""
    vectors = embeddings(spark, sf_dir)
    coded = written(N.with_codes(vectors, "embedding"), "codes")
    query = N.first_vector(vectors, "vec_id", "embedding")
    found = N.hamming_then_cosine(coded, "vec_id", "embedding", query, 20)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@catalogue.query(f"""
    WITH {DOUBLES}, {MEANS},
    s AS (SELECT label, vec_id, round(list_cosine_similarity(q, v), 6) AS score FROM m JOIN (SELECT vec_id, v FROM e) ON true)
    SELECT label, vec_id, score, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank
    FROM s QUALIFY rank <= 10
""")
def nearest_top_k(spark, sf_dir):
    """The ten vectors nearest to each label's mean."""
    found = N.top_k(embeddings(spark, sf_dir), "vec_id", "embedding", label_means(spark, sf_dir), "label", "q", k=10)
    return found.select(
        F.col("query_id").cast("int").alias("label"),
        F.col("item_id").alias("vec_id"),
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


@catalogue.query(f"""
    WITH {DOUBLES}, {MEANS}, o AS (SELECT row_number() OVER (ORDER BY label) - 1 AS column_no, q FROM m)
    SELECT vec_id, column_no, round(list_inner_product(v, q), 6) AS score FROM e JOIN o ON true
""")
def dot_matrix(spark, sf_dir):
    """Every vector times every label mean."""
    product = N.dot_matrix(embeddings(spark, sf_dir), "vec_id", "embedding", label_means(spark, sf_dir), "label", "q")
    rows = product.select("vec_id", F.posexplode("scores").alias("column_no", "score"))
    return rows.select("vec_id", F.col("column_no").cast("bigint").alias("column_no"), F.round("score", 6).alias("score"))


@catalogue.query(f"""
    WITH {DOUBLES},
    s AS (SELECT a.vec_id AS vec_id, b.vec_id AS other_id, round(list_cosine_similarity(a.v, b.v), 6) AS score
          FROM e a JOIN e b ON a.vec_id <> b.vec_id)
    SELECT vec_id, other_id, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, other_id) AS rank
    FROM s QUALIFY rank <= 3
""")
def all_pairs_top_3(spark, sf_dir):
    """The matrix of the table with itself, kept to the three best of every row."""
    found = N.all_pairs_top_k(embeddings(spark, sf_dir), "vec_id", "embedding", k=3)
    return found.select(
        F.col("query_id").alias("vec_id"),
        F.col("item_id").alias("other_id"),
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


ASKED = "q AS (SELECT vec_id AS query_id, v AS q FROM e WHERE vec_id % 100 = 0)"
CELLS = 16


def asked_vectors(spark, sf_dir):
    return embeddings(spark, sf_dir).filter(F.col("vec_id") % 100 == 0)


@catalogue.query(f"""
    WITH {DOUBLES}, {ASKED},
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(q, v), 6) AS score FROM q JOIN e ON vec_id <> query_id)
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM s QUALIFY rank <= 10
""")
def nearest_in_cells(spark, sf_dir):
    """The ten nearest vectors of every hundredth one, from cells read until no other can hold a nearer one."""
    index = C.build_cells(embeddings(spark, sf_dir), "vec_id", "embedding", CELLS)
    found = C.search_cells(index, asked_vectors(spark, sf_dir), "vec_id", "embedding", k=10, probes=4, exact=True, include_self=False)
    return found.select("query_id", F.col("item_id").alias("vec_id"), "score", F.col("rank").cast("bigint").alias("rank"))


@catalogue.query(columns="query_id bigint, vec_id bigint, score double, rank bigint", holds=lambda r: -1 <= r.score <= 1 and 1 <= r.rank <= 10 and (r.rank > 1 or r.vec_id == r.query_id))
def nearest_probed_cells(spark, sf_dir):
    """The same from as many cells as find 97 per cent of the ten best of a sample of the queries."""
    index = C.build_cells(embeddings(spark, sf_dir), "vec_id", "embedding", CELLS)
    asked = written(asked_vectors(spark, sf_dir), "asked-vectors")
    probes = C.probes_for_recall(index, asked, "vec_id", "embedding", k=10, recall=0.97)
    found = C.search_cells(index, asked, "vec_id", "embedding", k=10, probes=probes)
    return found.select("query_id", F.col("item_id").alias("vec_id"), "score", F.col("rank").cast("bigint").alias("rank"))


@catalogue.query(f"""
    WITH {DOUBLES}, {ASKED},
    d AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(range(1, len(v) + 1), lambda i: CASE WHEN (v[i] > 0) <> (q[i] > 0) THEN 1 ELSE 0 END)) AS INTEGER) AS distance FROM q, e)
    SELECT query_id, vec_id, distance FROM d WHERE distance <= 18
""")
def hamming_neighbours(spark, sf_dir):
    """All vectors whose sign bits differ in at most 18 of 64 places from those of every hundredth one."""
    coded = N.with_codes(embeddings(spark, sf_dir), "embedding").select("vec_id", "code")
    index = H.code_index(coded, "vec_id", "code", words=1)
    found = H.within_radius(index, coded.filter(F.col("vec_id") % 100 == 0), "vec_id", "code", radius=18, words=1)
    return found.select("query_id", F.col("id").alias("vec_id"), "distance")
