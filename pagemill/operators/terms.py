"""Term statistics over a token column: counts, vocabulary, TF, IDF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.vectors import sparse_entries
from pagemill.session import lookup_join


def term_counts(documents: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(key, term, tf)``, counted where the document is: no shuffle of tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            encoded = lists.flatten().dictionary_encode()
            terms = max(len(encoded.dictionary), 1)
            pair, tf = np.unique(row * terms + encoded.indices.to_numpy(), return_counts=True)
            columns = [batch.column(0).take(pa.array(pair // terms)), encoded.dictionary.take(pa.array(pair % terms)), pa.array(tf)]
            yield pa.RecordBatch.from_arrays(columns, [key, "term", "tf"])

    key_type = dict(documents.dtypes)[key]
    present = documents.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    return present.mapInArrow(count, f"`{key}` {key_type}, term string, tf long")


def document_terms(documents: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(key, terms, tfs)``: every document's distinct terms and how often each occurs, a row per document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            encoded = lists.flatten().dictionary_encode()
            terms = max(len(encoded.dictionary), 1)
            pair, tf = np.unique(row * terms + encoded.indices.to_numpy(), return_counts=True)
            bounds = pa.array(np.searchsorted(pair // terms, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, x) for x in (encoded.dictionary.take(pa.array(pair % terms)), pa.array(tf))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [key, "terms", "tfs"])

    key_type = dict(documents.dtypes)[key]
    present = documents.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    return present.mapInArrow(count, f"`{key}` {key_type}, terms array<string>, tfs array<long>")


def vocabulary(documents: DataFrame, tokens: Column, size: int) -> DataFrame:
    """The ``size`` most frequent terms ``(term, n, df)``, alphabetical on equal counts."""
    rows = term_counts(documents.select(F.lit(0).alias("_row"), tokens.alias("_tokens")), "_row", F.col("_tokens"))
    counts = rows.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("df"))
    return counts.orderBy(F.desc("n"), "term").limit(size)


def count_vectorizer(terms: list[str], input_col: str, output_col: str) -> CountVectorizerModel:
    """Term-frequency model over a vocabulary; ``transform`` counts inside each row, without a shuffle.

    Unlike a fitted ``CountVectorizer`` the terms at the cut are defined.
    """
    return CountVectorizerModel.from_vocabulary(terms, inputCol=input_col, outputCol=output_col)


def vocabulary_tf(documents: DataFrame, tokens: Column, size: int = 10_000) -> tuple[DataFrame, list[str]]:
    """Add ``content_tokenized`` and its TF vector ``raw_features``; returns the ``size`` terms too."""
    terms = [row["term"] for row in vocabulary(documents, tokens, size).collect()]
    model = count_vectorizer(terms, "content_tokenized", "raw_features")
    return model.transform(documents.withColumn("content_tokenized", tokens)), terms


def vocabulary_tfidf(documents: DataFrame, tokens: Column, size: int = 10_000) -> tuple[DataFrame, list[str]]:
    """``vocabulary_tf`` plus the IDF weighting ``content_tfidf``.

    The pass that finds the vocabulary also counts documents per term, so weighting needs no fit of its own.
    """
    n_documents = documents.agg(F.count("*")).scalar()
    stats = vocabulary(documents, tokens, size).withColumn("idf", idf_weight(n_documents, F.col("df"))).collect()
    model = count_vectorizer([row["term"] for row in stats], "content_tokenized", "raw_features")
    counted = model.transform(documents.withColumn("content_tokenized", tokens))
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([row["idf"] for row in stats]), inputCol="raw_features", outputCol="content_tfidf"
    )
    return weigh.transform(counted), model.vocabulary


def vector_terms(features: DataFrame, key: str, vector: str, terms: list[str], value: str) -> DataFrame:
    """Sparse vectors back to rows ``(key, term, value)``."""
    spark = features.sparkSession
    names = spark.createDataFrame(list(enumerate(terms)), "index int, term string")
    entries = features.select(key, F.inline(sparse_entries(F.col(vector))).alias("index", value))
    return lookup_join(entries, names, "index").select(key, "term", value)


def idf_weight(n_documents: Column, document_frequency: Column) -> Column:
    """``ln((N + 1) / (df + 1))``."""
    return F.log((n_documents + 1) / (document_frequency + 1))


def term_idf(counted: DataFrame) -> DataFrame:
    """``(term, df, idf)`` over all documents of ``document_terms``; counted before the shuffle."""
    n_documents = counted.agg(F.count("*")).scalar()
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return frequency.select("term", "df", idf_weight(n_documents, F.col("df")).alias("idf"))
