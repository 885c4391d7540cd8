"""Text features as a Spark ML pipeline: tokens, Word2Vec, hashed term frequency, IDF."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.word_vectors import HEAD_WORDS, WordVectors

# The parameters the published columns were made with.
VECTOR_SIZE = 5
SEED = 42
HASHED_FEATURES = 20

# How text is cut into tokens, in SQL over ``content``.
TOKENIZERS = {
    "space": "split({content}, ' ')",
    "whitespace": "filter(split({content}, '[\\\\s\\\\x0B\\\\x1C-\\\\x1F\\\\x85\\\\p{{Z}}]+'), t -> t <> '')",
}


def feature_pipeline(
    content: str = "content", partitions: int = 1, min_count: int = 5, tokenizer: str = "space", binary: bool = False,
    head_words: int = HEAD_WORDS,
) -> Pipeline:
    """Tokens, document embedding, hashed TF and its IDF weighting.

    ``tokenizer`` is ``space`` or ``whitespace``. ``binary`` content is decoded as UTF-8, bad bytes left out. Word2Vec trains in
    ``partitions`` tasks; their number, and which rows each has, change the vectors. It knows all tokens that occur ``min_count``
    times; only the ``head_words`` most frequent are on the driver.
    """
    text = f"`{content}`"
    if binary:
        text = f"replace(make_valid_utf8(cast({text} AS string)), '\ufffd', '')"
    tokens = TOKENIZERS[tokenizer].format(content=f"coalesce({text}, '')")
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {tokens} AS content_tokenized FROM __THIS__"),
            WordVectors("content_tokenized", "content_embedded", VECTOR_SIZE, SEED, min_count, partitions, head_words),
            HashingTF(numFeatures=HASHED_FEATURES, inputCol="content_tokenized", outputCol="raw_features"),
            IDF(inputCol="raw_features", outputCol="content_idf"),
        ]
    )


def fit_features(
    documents: DataFrame,
    content: str = "content",
    partitions: int | None = None,
    min_count: int = 5,
    tokenizer: str = "space",
    binary: bool = False,
    head_words: int = HEAD_WORDS,
) -> PipelineModel:
    """Fit on the content column alone; rows without content take no part. Trains in as many tasks as the cluster has cores
    unless ``partitions`` says otherwise."""
    texts = documents.select(content).filter(F.col(content).isNotNull())
    partitions = partitions or documents.sparkSession.sparkContext.defaultParallelism
    return feature_pipeline(content, partitions, min_count, tokenizer, binary, head_words).fit(texts)


def known_tokens(model: PipelineModel, documents: DataFrame, key: str) -> DataFrame:
    """``(key, n_known)``: how many tokens of each document the embedding knows. Keys tell rows apart."""
    rows = model.stages[1].summed(model.stages[0].transform(documents))
    return rows.select(key, F.col("_known").alias("n_known"))


def transform_features(model: PipelineModel, documents: DataFrame) -> DataFrame:
    """Add the feature columns as ML vectors; NULL content has the features of an empty text."""
    tokens, words, hashed, idf = model.stages
    featured = words.transform(idf.transform(hashed.transform(tokens.transform(documents))))  # tokens need not go through its join
    return featured.select(*documents.columns, "content_tokenized", "content_embedded", "raw_features", "content_idf")


def hashed_tf(documents: DataFrame, tokens: Column, size: int = HASHED_FEATURES) -> DataFrame:
    """Add ``raw_features``: term frequency by hashed bucket."""
    tokenized = documents.withColumn("content_tokenized", tokens)
    return HashingTF(numFeatures=size, inputCol="content_tokenized", outputCol="raw_features").transform(tokenized)


def hashed_tfidf(documents: DataFrame, tokens: Column, size: int = HASHED_FEATURES) -> DataFrame:
    """Add ``raw_features`` and its IDF weighting ``content_idf``."""
    counted = hashed_tf(documents, tokens, size)
    return IDF(inputCol="raw_features", outputCol="content_idf").fit(counted).transform(counted)


def at_rest(features: DataFrame) -> DataFrame:
    """The published shape: vectors as arrays, tokens and raw counts dropped."""
    arrays = {name: vector_to_array(name) for name in ("content_embedded", "content_idf")}
    return features.withColumns(arrays).drop("content_tokenized", "raw_features")
