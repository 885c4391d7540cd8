"""Token and language expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prompt a retrieval query is encoded with.
RETRIEVAL_PROMPT = "Represent this sentence for searching relevant passages: "

# Frequent function words per language, for tables that carry no language column.
STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "mit", "von", "zu", "den", "auf", "für"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "with", "are"],
    "es": ["el", "los", "que", "y", "en", "un", "por", "con", "del", "las", "una", "se"],
    "fr": ["le", "les", "et", "des", "est", "une", "du", "dans", "pour", "qui", "pas", "sur"],
}

# Unicode white space, as text tokenizers outside the JVM split it.
WHITE_SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"


def space_tokens(text: Column) -> Column:
    """Split at single spaces: empty tokens and line breaks stay in."""
    return F.split(text, " ")


def whitespace_tokens(text: Column) -> Column:
    """Split at runs of white space, no empty tokens; ``[]`` for NULL."""
    tokens = F.filter(F.split(text, WHITE_SPACE), lambda t: t != "")
    return F.coalesce(tokens, F.array().cast("array<string>"))


def retrieval_prompt(query: Column) -> Column:
    return F.concat(F.lit(RETRIEVAL_PROMPT), query)


def guess_language(text: Column, stop_words: dict[str, list[str]] | None = None) -> Column:
    """Language with the most stop words, alphabetical on ties; NULL when no word votes. Computed inside the row."""

    def votes(tokens: Column) -> Column:
        def vote(lang: str, words: list[str]) -> Column:
            count = F.size(F.filter(tokens, lambda token: token.isin(words)))
            return F.struct((-count).alias("less"), F.lit(lang).alias("lang"))

        counted = [vote(lang, words) for lang, words in (stop_words or STOP_WORDS).items()]
        return F.array_min(F.array(*counted))

    winner = F.transform(F.array(whitespace_tokens(F.lower(text))), votes)[0]
    return F.transform(F.array(winner), lambda w: F.when(w["less"] < 0, w["lang"]))[0]
