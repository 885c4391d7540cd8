"""Secrets in texts: candidates by pattern, false positives removed by a random forest. DataFrame functions only.

A candidate is a run of sixteen or more key characters, or what a secret's name is set to. The forest looks at its length,
changes of character kind, coverage by a dictionary of common word pieces, the path it stands in and the words around
it, and learns from labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.language import training_rows
from pagemill.session import written

NAME = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|auth)"
SET = rf"(?i:{NAME}[a-z_-]{{0,12}}[\"']?[=:][\"']?)"
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
CANDIDATE = rf"{SET}[^\s\"',;]{{6,}}|{RUN}"
# Fixed formats of keys that their issuers publish.
ISSUED = [r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"AIza[A-Za-z0-9_-]{35}", r"sk_live_[A-Za-z0-9]{24,}", r"glpat-[A-Za-z0-9_-]{20}"]
FEATURES = ["n_chars", "runs", "digits", "capitals", "small", "marks", "variety", "is_hex", "vowels", "covered", "slashes", "is_path", "quoted", "is_set", "named_here", "named_before", "named_after", "set_before", "issued"]
#: Dictionary entries; more make coverage slower, not wider by much.
MOST_PIECES = 300


def dictionary(path: str, most: int = MOST_PIECES) -> list[str]:
    """The first ``most`` ASCII pieces of three or more small letters of a public sentencepiece vocabulary, in its order of use."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i).removeprefix("▁") for i in range(model.get_piece_size()))
    return list(dict.fromkeys(p for p in every if len(p) >= 3 and p.isascii() and p.isalpha() and p.islower()))[:most]


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, word_no, word, before, after, value`` of every candidate; words are parted by white space and numbered from 0."""
    words = docs.select(F.col(key).alias("id"), F.split(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D]", " ")), " +").alias("words"))
    met = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.length(F.get("words", i)) >= 10) & F.rlike(F.get("words", i), F.lit(CANDIDATE)))

    def around(i: Column) -> Column:
        near = lambda shift: F.coalesce(F.get("words", i + shift), F.lit(""))
        return F.struct(i.alias("word_no"), F.get("words", i).alias("word"), F.concat_ws(" ", near(-2), near(-1)).alias("before"), near(1).alias("after"))

    rows = words.select("id", F.explode(F.transform(met, around)).alias("c")).select("id", "c.*")
    found = rows.withColumn("found", F.explode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))))
    return found.withColumn("value", F.regexp_replace("found", f"^{SET}", "")).withColumn("start", F.instr("word", F.col("value"))).filter("length(value) >= 6")


def share(value: Column, kind: str) -> Column:
    return (F.length(value) - F.length(F.regexp_replace(value, kind, ""))) / F.length(value)


def with_features(found: DataFrame, pieces: list[str]) -> DataFrame:
    """Candidates with the columns of ``FEATURES``."""
    value, head = F.col("value"), F.expr("left(word, start - 1)")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[^aA0]+", "-")
    listed = "|".join(sorted(pieces, key=lambda p: (-len(p), p))) or "$^"
    flag = lambda c: c.cast("double")
    made = {
        "n_chars": F.length(value).cast("double"),
        "runs": F.length(kinds) / F.length(value),
        "digits": share(value, "[0-9]"),
        "capitals": share(value, "[A-Z]"),
        "small": share(value, "[a-z]"),
        "marks": share(value, "[^A-Za-z0-9]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "is_hex": flag(F.rlike(value, F.lit("^[0-9a-f]+$|^[0-9A-F]+$"))),
        "vowels": share(value, "[aeiouAEIOU]"),
        "covered": share(F.lower(value), listed),
        "slashes": (F.length("word") - F.length(F.replace("word", F.lit("/"), F.lit("")))).cast("double"),
        "is_path": flag(F.rlike("word", F.lit(r"://|^[./~]*/|\\|\.[a-z]{2,4}$"))),
        "quoted": flag(F.rlike(head, F.lit("[\"'`]$"))),
        "is_set": flag(F.rlike(head, F.lit("[=:][\"'`]?$"))),
        "named_here": flag(F.rlike(head, F.lit(f"(?i){NAME}"))),
        "named_before": flag(F.rlike("before", F.lit(f"(?i){NAME}|\\bkey\\b"))),
        "named_after": flag(F.rlike("after", F.lit(f"(?i){NAME}|\\bkey\\b"))),
        "set_before": flag(F.rlike("before", F.lit("[=:]$"))),
        "issued": flag(F.rlike(value, F.lit("^(?:" + "|".join(ISSUED) + ")$"))),
    }
    return found.withColumns(made)


def findings(found: DataFrame) -> DataFrame:
    """Candidates whose ``label`` is beyond doubt: 1 for an issuer's format or a mixed value that a secret's name is set to, 0
    for letters of one case, numbers and dashes alone, and plain words and paths without a secret's name."""
    named = (F.col("named_here") + F.col("named_before")) > 0
    given = (F.col("is_set") + F.col("set_before")) > 0
    mixed = (F.col("digits") > 0.1) & (F.col("small") + F.col("capitals") > 0.1) & (F.col("covered") < 0.5)
    plain = F.rlike("value", F.lit("^(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+|[-_=+/]+|(?:[A-Za-z]?[a-z]+[-_/])+[a-z]*)$")) & (F.col("issued") == 0)
    path = (F.col("is_path") == 1) & (F.col("slashes") > 0) & (F.col("digits") < 0.2) & (F.col("issued") == 0)
    label = F.when((F.col("issued") == 1) | named & given & mixed, 1).when((plain | path) & ~(named & given), 0)
    return found.withColumn("label", label).filter("label is not null")


def fit_forest(labelled: DataFrame, per_label: int = 2000, trees: int = 30, depth: int = 6) -> RandomForestClassificationModel | None:
    """Forest on at most about ``per_label`` findings of either label; None without both labels."""
    sample = written(training_rows(labelled, "value", "label", per_label).select("label", *FEATURES).orderBy("label", *FEATURES).coalesce(1), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=11, subsamplingRate=0.8, probabilityCol="probability")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.withColumn("label", F.col("label").cast("double"))).select("features", "label"))


def scan_secrets(docs: DataFrame, pieces: list[str], key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """One row per secret: key, ``word_no`` (from 0), ``start`` (in the word, from 1), ``n_chars``, ``value_sha256``, ``score``, ``value``.

    ``labelled`` holds findings with ``label`` and the columns of ``FEATURES``; without it those candidates of ``docs``
    teach that ``findings`` is sure of. With findings of one label only no forest is fitted and those labelled 1 are
    returned with score 1. Null and empty texts have no candidates. Rows that repeat a key are scanned each on their
    own. Texts are not shuffled; candidates are written once.
    """
    found = written(with_features(candidates(docs, key, text), pieces), "candidates")
    labelled = findings(found) if labelled is None else labelled
    forest = fit_forest(labelled)
    if forest is None:
        scored = findings(found).filter("label = 1").withColumn("score", F.lit(1.0))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = forest.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    value = F.col("value")
    return scored.filter(F.col("score") >= least).select(F.col("id").alias(key), F.col("word_no").cast("long").alias("word_no"), F.col("start").cast("long").alias("start"), F.length(value).cast("long").alias("n_chars"), F.sha2(value, 256).alias("value_sha256"), F.round("score", 6).alias("score"), "value")
