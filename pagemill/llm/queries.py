"""The registered queries of this subpackage, each next to its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.decontaminate import benchmark_matches
from pagemill.llm.dedup import exact_duplicates
from pagemill.llm.jaccard import jaccard_components
from pagemill.llm.language import LanguageModel, fit_language_model, predict_language
from pagemill.llm.fill_middle import fill_in_middle, restored
from pagemill.llm.html_paths import extract_pages
from pagemill.llm.licenses import scan_licenses
from pagemill.llm.log_bilinear import score_texts
from pagemill.llm.packing import pack_documents
from pagemill.llm.quality import fit_quality, quality_score
from pagemill.llm.secrets import dictionary, scan_secrets
from pagemill.llm.simplex_clusters import cluster_vectors, with_inertia
from pagemill.llm.token_counts import count_tokens
from pagemill.session import apply_settings
from workload import Catalogue, table

catalogue = Catalogue()

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % folds


def language_model(spark: SparkSession, sf_dir: str) -> LanguageModel:
    """Fitted on the rows whose fold of three is not 1."""
    return fit_language_model(table(spark, sf_dir, "documents").filter(fold("doc_id", 3) != 1), PIECES)


@catalogue.query(columns="doc_id bigint, held_out boolean, lang_pred string, score double", holds=lambda r: r.lang_pred and 0 <= r.score <= 1)
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_model(apply_settings(spark), sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    guess = docs.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(True)).alias("held_out"), predict_language(model, docs).alias("guess"))
    return guess.select("doc_id", "held_out", "guess.lang_pred", "guess.score")


@catalogue.query(
    """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
              doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(apply_settings(spark), sf_dir, "documents")).drop("bucket", "chain")


#: Pairs by the shingles they share, then everything that each document reaches.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@catalogue.query(JACCARD_SQL)
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(apply_settings(spark), sf_dir, "documents"))


@catalogue.query(columns="doc_id bigint, item_id bigint, edits int, item_words int, start_word bigint, end_word bigint, similarity double", holds=lambda r: 0 <= r.edits <= 0.2 * r.item_words and r.start_word < r.end_word)
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(apply_settings(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@catalogue.query(columns="doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint", holds=lambda r: 0 < r.length and r.start + r.length <= r.doc_tokens and r.offset + r.length <= 4096)
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(apply_settings(spark), sf_dir, "documents"), WORD_TOKENIZER)


@catalogue.query(columns="doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint", holds=lambda r: r.n_words <= r.n_tokens and r.n_unknown <= r.n_tokens)
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(apply_settings(spark), sf_dir, "documents"), PIECES)


@catalogue.query(columns="doc_id bigint, held_out boolean, score double, predicted int", holds=lambda r: 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3))
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(apply_settings(spark), sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(True)).alias("held_out")
    scored = docs.select("doc_id", held_out, quality_score(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@catalogue.query(columns="page_id bigint, url string, text string, n_chars bigint", holds=lambda r: r.n_chars == len(r.text) and r.text == r.text.strip())
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(apply_settings(spark), sf_dir, "pages"))


@catalogue.query(columns="doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double", holds=lambda r: 0 <= r.score <= 1 and (r.n_base > 0) == (r.first_word is not None) == bool(r.base_labels) and set(r.base_labels.split(',')) - {''} <= set(r.labels.split(',')))
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(apply_settings(spark), sf_dir, "documents")).drop("detections")


@catalogue.query(columns="doc_id bigint, word_no bigint, start bigint, n_chars bigint, value_sha256 string, score double", holds=lambda r: 0.5 <= r.score <= 1 and r.n_chars > 0 and len(r.value_sha256) == 64)
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the secrets themselves."""
    return scan_secrets(table(apply_settings(spark), sf_dir, "documents"), dictionary(PIECES)).drop("value")


@catalogue.query(columns="doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double", holds=lambda r: 1 <= r.n_tokens and r.n_known <= r.n_tokens and r.score < 0 and r.base_score < 0)
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(table(apply_settings(spark), sf_dir, "documents").select("doc_id", "text"), fold("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _clustering_sql(clusters: int = 8, rounds: int = 10) -> str:
    """A step for every round; distances and means in whole numbers."""
    gap = "CAST(list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    nearest = "SELECT e.r, e.vec_id, e.v, min({d: " + gap + ", c: c.c}) AS near FROM e, c%d c GROUP BY ALL"
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({nearest % i})")
        steps.append(f"s{i} AS (SELECT near.c AS c, unnest(v) AS x, unnest(range(64)) AS pos FROM a{i})")
        steps.append(f"m{i} AS (SELECT c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM s{i} GROUP BY c, pos)")
        steps.append(f"f{i} AS (SELECT c, list((s - ((s % n + n) % n)) // n ORDER BY pos) AS v FROM m{i} GROUP BY c)")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(f.v, o.v) AS v FROM c{i} o LEFT JOIN f{i} f ON f.c = o.c)")
    return f"""
WITH e AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM e ORDER BY h LIMIT {clusters})
), {", ".join(steps)}, a AS MATERIALIZED ({nearest % rounds})
SELECT a.vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a JOIN c{rounds} c ON c.c = a.near.c
"""


@catalogue.query(_clustering_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster_vectors(table(apply_settings(spark), sf_dir, "embeddings"))).drop("compared")


@catalogue.query(
    """WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), x AS (
    SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS one, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS two,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
    SELECT *, least(one, two) AS low, greatest(one, two) AS high, substr(t, 1, low) AS prefix, substr(t, low + 1, high - low) AS middle, substr(t, high + 1) AS suffix FROM x
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(apply_settings(spark), sf_dir, "documents"))
    texts = made.withColumn("restored", restored(F.col("output"), F.col("form")))
    digest = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return texts.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)
