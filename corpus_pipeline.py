"""Clean a corpus into packed training sequences: the stages that ``run`` applies to ``documents``, in order.

A stage takes what its predecessor kept and, but for the last, returns the columns of ``documents``. Rows with null text
are rejected by the first stage; a null ``doc_id`` is a document like any other. Documents that share a ``doc_id`` with
a rejected one of the same text are rejected with it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.decontaminate import benchmark_matches
from pagemill.llm.dedup import exact_duplicates
from pagemill.llm.jaccard import jaccard_components
from pagemill.llm.language import UNDETERMINED, predict_language
from pagemill.llm.packing import pack_documents
from pagemill.llm.queries import WORD_TOKENIZER, language_model
from pagemill.session import apply_settings, written
from workload import Catalogue, table

catalogue = Catalogue()

#: A text whose best language is less likely than this is rejected.
LEAST_SCORE = 0.5


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid4().hex}"


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a language that the labelled ones teach."""
    model = language_model(apply_settings(spark), sf_dir)
    guess = fresh("guess")
    kept = docs.withColumn(guess, predict_language(model, docs)).filter((F.col(f"{guess}.lang_pred") != UNDETERMINED) & (F.col(f"{guess}.score") >= LEAST_SCORE))
    return kept.drop(guess)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id; rows that repeat it with the same text are that one document."""
    apply_settings(spark)
    own, key, digest = fresh("sha"), fresh("key"), fresh("digest")
    kept = exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(digest))
    marked = docs.withColumn(own, F.sha2(F.coalesce("text", F.lit("")), 256))
    return marked.join(kept, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(digest)), "left_semi").drop(own)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of texts that share 80 per cent of their five-word shingles: the smallest doc_id.

    A row is known by a hash of its doc_id and text, so that other texts of the same doc_id, or without one, are decided for
    themselves; a null doc_id counts as larger than any other.
    """
    apply_settings(spark)
    row, component, kept, least = fresh("row"), fresh("component"), fresh("kept"), fresh("least")
    marked = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = jaccard_components(marked.select(row, "text"), key=row).select(row, F.col("component_id").alias(component))
    named = found.join(marked.select(row, F.col("doc_id").alias(least)).distinct(), row)
    order = F.struct(F.col(least).isNull(), F.col(least), F.col(row))
    first = named.groupBy(component).agg(F.min_by(row, order).alias(kept)).select(F.col(kept).alias(row))
    return marked.join(first, row, "left_semi").drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    apply_settings(spark)
    key = fresh("key")
    found = written(benchmark_matches(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(key)), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens."""
    return pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("language", in_known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]
#: Language scores and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else written(docs, name), sf_dir)
    return docs


@catalogue.query(ORACLE_SQL, columns="doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint", holds=lambda r: 0 < r.length and r.start + r.length <= r.doc_tokens and r.offset + r.length <= 4096)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(apply_settings(spark), sf_dir)
