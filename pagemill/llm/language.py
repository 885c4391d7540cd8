"""Language identification by unigrams of word pieces, summed over all segmentations.

A language is a probability for every piece of a fixed public vocabulary. The chance of a word is the sum, over every way
to cut it into pieces, of the product of the pieces' probabilities: a forward pass over the word, never the best cut
alone. Probabilities come from expectation maximisation on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import lean
from pagemill.session import written

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"
#: No piece crosses a multiple of this many letters of a word, which keeps a product of chances within a double.
SPAN = 64
#: Chances carry this factor for each letter, the same for all languages, to stay far from zero.
LIFT = np.exp(4.0)
UNKNOWN = 1e-7
UNDETERMINED = "und"


def public_pieces(path: str) -> list[str]:
    """The lower-case letter pieces of a public sentencepiece vocabulary; a word's first piece begins with its mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in every if (w := p.removeprefix(START)).isalpha() and w == w.lower()} | {START})


def spans(word: str) -> list[str]:
    return [START + word[:SPAN], *(word[i : i + SPAN] for i in range(SPAN, len(word), SPAN))]


class Lattice:
    """All places of all pieces in a list of strings, ordered so that each is used after what it builds on."""

    def __init__(self, pieces: ahocorasick.Automaton, strings: list[str]):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        first = np.concatenate([[0], np.cumsum(lengths + 1)])
        found = [x for i, s in enumerate(strings) for end, (piece, size) in pieces.iter(s) for x in (i, end + 1, piece, size)]
        found = np.array(found, dtype=np.int64).reshape(-1, 4)
        order = np.lexsort((found[:, 0], found[:, 1]))
        word, end, self.piece, size = found[order].T
        self.into = first[word] + end
        self.out_of = self.into - size
        self.steps = np.searchsorted(end, np.arange(1, lengths.max(initial=0) + 2))
        self.first, self.last, self.lengths = first[:-1], first[1:] - 1, lengths
        self.by_length = np.argsort(-lengths, kind="stable")
        self.longer = np.searchsorted(-lengths[self.by_length], -np.arange(1, lengths.max(initial=0) + 1), side="right")

    def forward(self, chance: np.ndarray, unknown: float) -> np.ndarray:
        """Summed chance of every beginning of every string; a column for each language."""
        alpha = np.zeros((int(self.lengths.sum()) + len(self.lengths), chance.shape[1]))
        alpha[self.first] = 1.0
        for r, (a, b) in enumerate(zip(self.steps[:-1], self.steps[1:], strict=True), 1):
            at = self.first[self.by_length[: self.longer[r - 1]]] + r
            alpha[at] = alpha[at - 1] * unknown
            if b > a:
                into = self.into[a:b]
                heads = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
                alpha[into[heads]] += np.add.reduceat(alpha[self.out_of[a:b]] * chance[self.piece[a:b]], heads)
        return alpha

    def backward(self, chance: np.ndarray, unknown: float) -> np.ndarray:
        """Summed chance of every rest of every string, for one language."""
        beta = np.zeros(int(self.lengths.sum()) + len(self.lengths))
        beta[self.last] = 1.0
        for r in range(len(self.steps) - 1, 0, -1):
            a, b = self.steps[r - 1], self.steps[r]
            at = self.first[self.by_length[: self.longer[r - 1]]] + r
            beta[at - 1] += beta[at] * unknown
            np.add.at(beta, self.out_of[a:b], beta[self.into[a:b]] * chance[self.piece[a:b]])
        return beta


def automaton(pieces: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, piece in enumerate(pieces):
        found.add_word(piece, (i, len(piece)))
    found.make_automaton()
    return found


def fit_pieces(pieces: list[str], counts: dict[str, float], rounds: int = 4) -> np.ndarray:
    """Piece probabilities of one language from its words and how often each occurs."""
    found, lift = automaton(pieces), LIFT ** np.array([len(p) for p in pieces])
    strings, weight = [], []
    for word, n in counts.items():
        for s in spans(word):
            strings.append(s)
            weight.append(n)
    weight, p = np.array(weight, dtype=float), np.full(len(pieces), 1.0 / len(pieces))
    if not strings:
        return p
    lattice = Lattice(found, strings)
    owner = np.searchsorted(lattice.first, lattice.into, side="right") - 1
    for _ in range(rounds):
        chance = p * lift
        alpha, beta = lattice.forward(chance[:, None], UNKNOWN * LIFT)[:, 0], lattice.backward(chance, UNKNOWN * LIFT)
        share = alpha[lattice.out_of] * chance[lattice.piece] * beta[lattice.into] / alpha[lattice.last][owner]
        expected = np.bincount(lattice.piece, share * weight[owner], len(pieces)) + 0.05
        p = expected / expected.sum()
    return p


class LanguageModel:
    """Languages, pieces and their probabilities; scores batches of texts."""

    def __init__(self, languages: list[str], pieces: list[str], probability: np.ndarray):
        self.languages, self.pieces, self.probability = languages, pieces, probability

    def log_chances(self, words: list[str], found: ahocorasick.Automaton | None = None) -> np.ndarray:
        """Logarithm of every word's summed chance in every language, up to a term that all languages share."""
        chance = self.probability * (LIFT ** np.array([len(p) for p in self.pieces]))[:, None]
        cut = [spans(w) for w in words]
        lattice = Lattice(found or automaton(self.pieces), [s for c in cut for s in c])
        logs = np.log(lattice.forward(chance, UNKNOWN * LIFT)[lattice.last])
        return np.add.reduceat(logs, np.concatenate([[0], np.cumsum([len(c) for c in cut])[:-1]])) if words else np.zeros((0, len(self.languages)))

    def predictions(self, batches: Iterable[pd.Series], words_at_once: int = 60_000, words_kept: int = 400_000) -> Iterator[pd.DataFrame]:
        found, known, rows, used = automaton(self.pieces), {}, np.zeros((1024, len(self.languages))), 0
        for texts in batches:
            out: list[tuple[str, float]] = []
            held: list[list[str]] = []
            n = 0

            def settle():
                nonlocal rows, used, n
                if used > words_kept:
                    known.clear()
                    used = 0
                new = list({w for words in held for w in words if w not in known})
                for i in range(0, len(new), 8_000):
                    part = new[i : i + 8_000]
                    if used + len(part) > len(rows):
                        rows = np.concatenate([rows, np.zeros((max(len(rows), len(part)), rows.shape[1]))])
                    rows[used : used + len(part)] = self.log_chances(part, found)
                    known.update(zip(part, range(used, used + len(part)), strict=True))
                    used += len(part)
                for words in held:
                    out.append(self._predict(rows[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(axis=0)) if any(map(_has_letter, words)) else (UNDETERMINED, 0.0))
                held.clear()
                n = 0

            for text in texts:
                held.append(LETTERS.findall(text.lower()) if isinstance(text, str) else [])
                n += len(held[-1])
                if n > words_at_once:
                    settle()
            settle()
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    def _predict(self, logs: np.ndarray) -> tuple[str, float]:
        if not len(logs):
            return UNDETERMINED, 0.0
        best = int(logs.argmax())
        return self.languages[best], float(1 / np.exp(logs - logs[best]).sum())


def _has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def training_rows(docs: DataFrame, key: str, label: str, rows_per_label: int) -> DataFrame:
    """About ``rows_per_label`` rows of every label, chosen by a hash of the key at a rate that the label's count sets."""
    counts = docs.filter(F.col(label).isNotNull()).groupBy(label).count().collect()
    rates = [F.when(F.col(label) == r[0], min(1.0, rows_per_label / r[1])) for r in counts]
    share = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) / (1 << 30)
    return docs.filter(share < F.coalesce(*rates, F.lit(0.0)))


def fit_language_model(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang", texts_per_language: int = 600, words_per_language: int = 60_000) -> LanguageModel:
    """Fit on a sample of at most about ``texts_per_language`` whole texts of each language.

    Of the sample's words the ``words_per_language`` commonest of each language count, ties in order of the word; however
    many languages there are, the driver holds the words of one at a time. Rows without a word or language teach nothing;
    with no row left the model has no language and every text is undetermined.
    """
    pieces = public_pieces(path)
    sample = training_rows(docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null"), "k", "l", texts_per_language)
    words = sample.select("l", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{L}+)"), 1)).alias("w")).groupBy("l", "w").count()
    counted = written(words, "language_words")
    languages = sorted(r[0] for r in counted.select("l").distinct().collect())

    def commonest(language: str) -> dict[str, int]:
        own = counted.filter(F.col("l") == language).select("w", "count")
        return dict(own.orderBy(F.desc("count"), "w").limit(words_per_language).toPandas().itertuples(index=False))

    fitted = [fit_pieces(pieces, commonest(x)) for x in languages]
    return LanguageModel(languages, pieces, np.stack(fitted, axis=1) if fitted else np.zeros((len(pieces), 0)))


def predict_language(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """Struct ``lang_pred``, ``score`` (posterior chance, equal priors) for every text; und, 0 without a letter or text.

    Equal chances go to the language that comes first in the alphabet. Memory holds a batch's words and a bounded table
    of words already scored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from shared.value.predictions(lean(batches))

    return scored(F.col(text))
