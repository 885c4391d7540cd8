"""Tokens, language, term statistics, TF-IDF, text retrieval, looking at tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pagemill.functions import text as X
from pagemill.operators import pages as P
from pagemill.operators import terms as T
from pagemill.operators.nearest import top_k
from pagemill.operators.retrieval import tfidf_search
from pagemill.operators.tables import profile, random_rows
from pagemill.operators.text_index import build_text_index, search_text
from pagemill.operators.word_vectors import WordVectors
from pagemill.plans import features as E
from pagemill.session import written
from workload import Catalogue, spread_table, table

catalogue = Catalogue()

VOCABULARY = 10_000
WORDS = r"list_filter(regexp_split_to_array({}, '[\x09-\x0D\x1C-\x20\x{{85}}\p{{Z}}]+'), lambda x: x <> '')"
TEXT_WORDS = WORDS.format("text")


def documents(spark, sf_dir, *columns):
    return spread_table(spark, sf_dir, "documents", "doc_id", "text", *columns)


@catalogue.query("SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang")
def parquet_read(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


@catalogue.query("""
    SELECT doc_id, len(string_split(text, ' ')) AS n_tokens, md5(array_to_string(string_split(text, ' '), '|')) AS tokens
    FROM documents
""")
def space_tokens(spark, sf_dir):
    tokens = X.space_tokens(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id", F.size(tokens).cast("bigint").alias("n_tokens"), F.md5(F.array_join(tokens, "|")).alias("tokens")
    )


@catalogue.query(f"""
    SELECT doc_id, len({TEXT_WORDS}) AS n_tokens, md5(array_to_string({TEXT_WORDS}, '|')) AS tokens FROM documents
""")
def whitespace_tokens(spark, sf_dir):
    tokens = X.whitespace_tokens(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id", F.size(tokens).cast("bigint").alias("n_tokens"), F.md5(F.array_join(tokens, "|")).alias("tokens")
    )


@catalogue.query("SELECT item_id, 'Represent this sentence for searching relevant passages: ' || text AS prompt FROM benchmark")
def retrieval_prompt(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", X.retrieval_prompt(F.col("text")).alias("prompt"))


@catalogue.query("SELECT doc_id, text FROM documents WHERE lang = 'en'")
def english_only(spark, sf_dir):
    return P.in_language(table(spark, sf_dir, "documents"), "en").select("doc_id", "text")


# One count per language, in alphabetical order; the SQL side has its own lists.
VOTES = """
    (len(list_filter(w, lambda x: x IN ('der', 'die', 'das', 'und', 'ist', 'nicht', 'mit', 'von', 'zu', 'den', 'auf', 'für'))), 'de'),
    (len(list_filter(w, lambda x: x IN ('the', 'of', 'and', 'to', 'in', 'is', 'that', 'it', 'was', 'for', 'with', 'are'))), 'en'),
    (len(list_filter(w, lambda x: x IN ('el', 'los', 'que', 'y', 'en', 'un', 'por', 'con', 'del', 'las', 'una', 'se'))), 'es'),
    (len(list_filter(w, lambda x: x IN ('le', 'les', 'et', 'des', 'est', 'une', 'du', 'dans', 'pour', 'qui', 'pas', 'sur'))), 'fr')
"""


@catalogue.query(f"""
    WITH words AS (SELECT doc_id, {WORDS.format('lower(text)')} AS w FROM documents),
    votes AS (SELECT doc_id, unnest([{VOTES}]) AS v FROM words),
    named AS (SELECT doc_id, struct_extract(v, 1) AS n, struct_extract(v, 2) AS lang FROM votes),
    best AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) = 1)
    SELECT doc_id, CASE WHEN n > 0 THEN lang END AS lang_guess FROM best
""")
def language_vote(spark, sf_dir):
    return P.with_guessed_language(documents(spark, sf_dir)).select("doc_id", "lang_guess")


# Term statistics -----------------------------------------------------------------------------------------------------

COUNTED = f"tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TEXT_WORDS}) AS term FROM documents) GROUP BY ALL)"
KEPT = f"vocab AS (SELECT term, sum(tf) AS n, count(*) AS df FROM tf GROUP BY term ORDER BY n DESC, term LIMIT {VOCABULARY})"


@catalogue.query(f"WITH {COUNTED} SELECT doc_id, term, tf FROM tf")
def term_counts(spark, sf_dir):
    return T.term_counts(documents(spark, sf_dir), "doc_id", X.whitespace_tokens(F.col("text")))


@catalogue.query(f"WITH {COUNTED}, {KEPT} SELECT term, CAST(n AS BIGINT) AS n, df FROM vocab")
def vocabulary_terms(spark, sf_dir):
    return T.vocabulary(documents(spark, sf_dir), X.whitespace_tokens(F.col("text")), VOCABULARY)


@catalogue.query(f"""
    WITH {COUNTED}, {KEPT} SELECT doc_id, term, CAST(tf AS DOUBLE) AS tf FROM tf SEMI JOIN vocab USING (term)
""")
def vocabulary_tf(spark, sf_dir):
    """Sparse count vectors, read back by index and value."""
    tokens = X.whitespace_tokens(F.col("text"))
    features, terms = T.vocabulary_tf(documents(spark, sf_dir), tokens, VOCABULARY)
    return T.vector_terms(features, "doc_id", "raw_features", terms, "tf")


@catalogue.query(f"""
    WITH {COUNTED}, {KEPT},
    idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term)
    SELECT doc_id, term, round(tf * idf, 6) AS tfidf FROM tf SEMI JOIN vocab USING (term) JOIN idf USING (term)
""")
def vocabulary_tfidf(spark, sf_dir):
    tokens = X.whitespace_tokens(F.col("text"))
    features, terms = T.vocabulary_tfidf(documents(spark, sf_dir), tokens, VOCABULARY)
    rows = T.vector_terms(features, "doc_id", "content_tfidf", terms, "tfidf")
    return rows.withColumn("tfidf", F.round("tfidf", 6))


RETRIEVAL = f"""
    WITH {COUNTED},
    idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS idf FROM tf GROUP BY term),
    qtf AS (SELECT item_id, term, count(*) AS tf
            FROM (SELECT item_id, unnest({TEXT_WORDS}) AS term FROM benchmark) GROUP BY ALL),
    q AS (SELECT item_id, term, tf * idf AS w FROM qtf JOIN idf USING (term)),
    d AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
    qn AS (SELECT item_id, sqrt(sum(w * w)) AS len FROM q GROUP BY item_id),
    dn AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM d GROUP BY doc_id),
    dots AS (SELECT item_id, doc_id, sum(q.w * d.w) AS dot FROM q JOIN d USING (term) GROUP BY item_id, doc_id),
    scored AS (SELECT item_id, doc_id, round(dot / qn.len / dn.len, 6) AS score
               FROM dots JOIN qn USING (item_id) JOIN dn USING (doc_id) WHERE dot > 0)
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scored QUALIFY rank <= 5
"""


@catalogue.query(RETRIEVAL)
def tfidf_retrieval(spark, sf_dir):
    words = X.whitespace_tokens(F.col("text"))
    found = tfidf_search(
        documents(spark, sf_dir), "doc_id", words, table(spark, sf_dir, "benchmark"), "item_id", words, k=5
    )
    return found.select(F.col("query_id").alias("item_id"), "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


@catalogue.query(RETRIEVAL)
def indexed_retrieval(spark, sf_dir):
    """The same from a stored index, of which only blocks that can matter are read."""
    words = X.whitespace_tokens(F.col("text"))
    index = build_text_index(documents(spark, sf_dir), "doc_id", words)
    found = search_text(index, table(spark, sf_dir, "benchmark"), "item_id", words, k=5)
    return found.select(F.col("query_id").alias("item_id"), "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


# Spark ML features ---------------------------------------------------------------------------------------------------


@catalogue.query("SELECT doc_id, CAST(len(string_split(text, ' ')) AS DOUBLE) AS tf_total FROM documents")
def hashed_tf_total(spark, sf_dir):
    """Hashed counts of a document add up to its tokens."""
    features = E.hashed_tf(documents(spark, sf_dir), X.space_tokens(F.col("text")))
    counts = vector_to_array("raw_features")
    return features.select("doc_id", F.aggregate(counts, F.lit(0.0), lambda a, x: a + x).alias("tf_total"))


# Murmur3 (32 bits, seed 42) of the UTF-8 bytes of every distinct token, by blocks of four bytes and the tail, modulo 20.
MASK = 4294967295
HASHED_SQL = rf"""
    tokens AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents),
    raw AS (SELECT DISTINCT token, hex(encode(token)) AS x FROM tokens),
    parts AS (
        SELECT token, length(x) // 2 AS n,
               list_transform(range(0, length(x) // 8), lambda i: CAST(concat('0x', x[8*i+7:8*i+8], x[8*i+5:8*i+6], x[8*i+3:8*i+4], x[8*i+1:8*i+2]) AS UBIGINT)) AS blocks,
               x[length(x) // 8 * 8 + 1:] AS rest
        FROM raw
    ),
    tails AS (
        SELECT token, n, blocks, list_append(blocks, CASE WHEN rest = '' THEN 0::UBIGINT
               ELSE CAST(concat('0x', rest[5:6], rest[3:4], rest[1:2]) AS UBIGINT) END) AS every
        FROM parts
    ),
    once AS (SELECT token, n, len(blocks) AS m, list_transform(every, lambda k: (k * 3432918353::UBIGINT) & {MASK}::UBIGINT) AS ks FROM tails),
    turned AS (SELECT token, n, m, list_transform(ks, lambda k: (((k << 15) & {MASK}::UBIGINT) | (k >> 17))) AS ks FROM once),
    twice AS (SELECT token, n, m, list_transform(ks, lambda k: (k * 461845907::UBIGINT) & {MASK}::UBIGINT) AS ks FROM turned),
    chained AS (
        SELECT token, n, ks[m + 1] AS tail, list_reduce(list_prepend(42::UBIGINT, ks[1:m]), lambda h, k:
               (((((xor(h, k) << 13) & {MASK}::UBIGINT) | (xor(h, k) >> 19)) * 5::UBIGINT) + 3864292196::UBIGINT) & {MASK}::UBIGINT) AS h
        FROM twice
    ),
    f1 AS (SELECT token, xor(xor(h, tail), n::UBIGINT) AS h FROM chained),
    f2 AS (SELECT token, (xor(h, h >> 16) * 2246822507::UBIGINT) & {MASK}::UBIGINT AS h FROM f1),
    f3 AS (SELECT token, (xor(h, h >> 13) * 3266489909::UBIGINT) & {MASK}::UBIGINT AS h FROM f2),
    f4 AS (SELECT token, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM f3),
    placed AS (SELECT token, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 20 + 20) % 20 AS bucket FROM f4),
    counted AS (SELECT doc_id, bucket, count(*) AS tf FROM tokens JOIN placed USING (token) GROUP BY ALL),
    spread AS (SELECT bucket, count(*) AS df FROM counted GROUP BY bucket),
    every_bucket AS (
        SELECT d.doc_id, b.bucket, coalesce(c.tf, 0) AS tf, coalesce(s.df, 0) AS df, (SELECT count(*) FROM documents) AS n
        FROM documents d CROSS JOIN (SELECT unnest(range(20)) AS bucket) b
        LEFT JOIN counted c ON c.doc_id = d.doc_id AND c.bucket = b.bucket LEFT JOIN spread s ON s.bucket = b.bucket
    )
"""


@catalogue.query(f"WITH {HASHED_SQL} SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, CAST(tf AS DOUBLE) AS tf FROM every_bucket")
def hashed_tf(spark, sf_dir):
    """Every document's count in every bucket."""
    features = E.hashed_tf(documents(spark, sf_dir), X.space_tokens(F.col("text")))
    return features.select("doc_id", F.posexplode(vector_to_array("raw_features")).alias("bucket", "tf"))


@catalogue.query(f"""
    WITH {HASHED_SQL} SELECT doc_id, CAST(bucket AS INTEGER) AS bucket, round(tf * ln((n + 1) / (df + 1)), 5) AS weight FROM every_bucket
""")
def hashed_tfidf(spark, sf_dir):
    """Every document's weight in every bucket."""
    features = E.hashed_tfidf(documents(spark, sf_dir), X.space_tokens(F.col("text")))
    rows = features.select("doc_id", F.posexplode(vector_to_array("content_idf")).alias("bucket", "weight"))
    return rows.withColumn("weight", F.round("weight", 5))


@catalogue.query(f"""
    WITH {HASHED_SQL} SELECT doc_id, CAST(count(*) AS INTEGER) AS n_buckets, round(sum(tf * ln((n + 1) / (df + 1))), 4) AS total
    FROM every_bucket GROUP BY doc_id
""")
def hashed_idf_formula(spark, sf_dir):
    """The weights of a document's buckets, summed up."""
    features = E.hashed_tfidf(documents(spark, sf_dir), X.space_tokens(F.col("text")))
    weights = vector_to_array("content_idf")
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return features.select("doc_id", F.size(weights).alias("n_buckets"), F.round(total, 4).alias("total"))


# Tokens that occur five times in all documents are known to an embedding.
KNOWN_SQL = """
    WITH tokens AS (SELECT doc_id, unnest({tokens}) AS token FROM documents),
    known AS (SELECT token FROM tokens GROUP BY token HAVING count(*) >= 5)
    SELECT d.doc_id, count(k.token) AS n_known
    FROM documents d LEFT JOIN tokens t ON t.doc_id = d.doc_id LEFT JOIN known k ON k.token = t.token GROUP BY d.doc_id
"""


@catalogue.query(KNOWN_SQL.format(tokens="string_split(text, ' ')"))
def word2vec_known_tokens(spark, sf_dir):
    """What the feature job's embedding has learned of every document."""
    docs = documents(spark, sf_dir).withColumnRenamed("text", "content")
    return E.known_tokens(E.fit_features(docs), docs, "doc_id")


@catalogue.query(KNOWN_SQL.format(tokens=r"list_filter(regexp_split_to_array(text, '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+'), lambda t: t <> '')"))
def feature_job_binary(spark, sf_dir):
    """The same job over binary content, cut at runs of white space."""
    docs = documents(spark, sf_dir).select("doc_id", F.col("text").cast("binary").alias("content"))
    return E.known_tokens(E.fit_features(docs, tokenizer="whitespace", binary=True), docs, "doc_id")


@catalogue.query(columns="doc_id bigint, content_embedded array<double>", holds=lambda r: len(r.content_embedded) == 5)
def word2vec_embedding(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("words", X.space_tokens(F.col("text")))
    embedder = WordVectors("words", "v", E.VECTOR_SIZE, E.SEED, partitions=spark.sparkContext.defaultParallelism)
    embedded = embedder.fit(docs.select("words")).transform(docs)
    return embedded.select("doc_id", vector_to_array("v").alias("content_embedded"))


@catalogue.query(columns="doc_id bigint, content_embedded array<double>, content_idf array<double>", holds=lambda r: len(r.content_embedded) == 5 and len(r.content_idf) == 20 and min(r.content_idf) >= 0)
def feature_job(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumnRenamed("text", "content")
    return E.at_rest(E.transform_features(E.fit_features(docs), docs)).drop("content")


@catalogue.query(columns="query_id bigint, item_id bigint, score double, rank int", holds=lambda r: -1 <= r.score <= 1 and r.rank >= 1)
def embedding_retrieval(spark, sf_dir):
    """Benchmark texts as queries, embedded by the model of the documents; the nearest documents of each."""
    docs = documents(spark, sf_dir).withColumnRenamed("text", "content")
    queries = table(spark, sf_dir, "benchmark").withColumnRenamed("text", "content")
    model = E.fit_features(docs)
    embedded = written(E.at_rest(E.transform_features(model, docs)).select("doc_id", "content_embedded"), "embedded")
    asked = E.at_rest(E.transform_features(model, queries))
    return top_k(embedded, "doc_id", "content_embedded", asked, "item_id", "content_embedded", k=5)


# Looking at tables ---------------------------------------------------------------------------------------------------


@catalogue.query("""
    SELECT doc_id, text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id LIMIT 5
""")
def random_row_sample(spark, sf_dir):
    return random_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", n=5, seed=42)


PROFILE = " UNION ALL ".join(
    f"""SELECT '{name}' AS column_name, '{dtype}' AS dtype, count(*) AS n_rows, count(*) - count({name}) AS n_null,
        CAST(min({name}) AS VARCHAR) AS min_value, CAST(max({name}) AS VARCHAR) AS max_value FROM documents"""
    for name, dtype in [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
)


@catalogue.query(PROFILE)
def table_profile(spark, sf_dir):
    return profile(table(spark, sf_dir, "documents")).drop("n_distinct_estimate")


@catalogue.query("SELECT doc_id, text, lang, source FROM documents")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "documents").drop("n_chars")
