import itertools

import numpy as np
import pandas as pd
import pytest

from pagemill.llm import language
from pagemill.llm.language import LIFT, START, UNKNOWN, LanguageModel, Lattice, automaton, fit_language_model, fit_pieces, predict_language
from pagemill.llm.queries import PIECES


def every_segmentation(string, pieces, p):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(string) - 1):
        bounds = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(string)]
        parts = [string[a:b] for a, b in itertools.pairwise(bounds)]
        for ways in itertools.product(*[([p[pieces.index(x)]] if x in pieces else []) + ([UNKNOWN] if len(x) == 1 else []) for x in parts]):
            total += np.prod(ways)
    return total


def test_forward_sums_all_segmentations():
    pieces = [START, START + "a", "a", "ab", "b", "bab", START + "ab", "abab"]
    p = np.array([0.2, 0.1, 0.2, 0.1, 0.15, 0.05, 0.1, 0.1])
    words = ["abab", "b", "aab", "xab", "bbbbb"]
    model = LanguageModel(["l"], pieces, p[:, None])
    got = model.log_chances(words)[:, 0]
    for word, log in zip(words, got):
        assert np.isclose(log, np.log(every_segmentation(START + word, pieces, p)) + np.log(LIFT) * (len(word) + 1))


def test_backward_meets_forward():
    pieces = [START, "a", "ab", "b", START + "ab"]
    chance = np.array([0.2, 0.3, 0.1, 0.2, 0.2])
    lattice = Lattice(automaton(pieces), [START + "abab", START + "b"])
    alpha, beta = lattice.forward(chance[:, None], 0.01)[:, 0], lattice.backward(chance, 0.01)
    assert np.allclose(alpha[lattice.last], beta[lattice.first])


def test_fit_raises_the_chance_of_its_words():
    pieces = [START, "a", "b", "ab", "ba", START + "a"]
    p = fit_pieces(pieces, {"abab": 10.0, "ab": 5.0})
    assert np.isclose(p.sum(), 1) and p[pieces.index("ab")] > p[pieces.index("ba")]


def test_learned_languages_and_odd_texts(frame, odd_rows):
    one, two = "the thing was there with other things", "der hund und die katze sind nicht hier"
    rows = [(i, f"{one} {i}", "en") for i in range(30)] + [(100 + i, f"{two} {i}", "de") for i in range(30)]
    docs = frame(rows)
    model = fit_language_model(docs, PIECES)
    assert model.languages == ["de", "en"]
    probe = frame([(1, one), (2, two.upper()), (3, None), (4, ""), (5, "123 ² --"), (6, "x" * 100_000), *[(i, t) for i, t, _ in odd_rows]])
    got = probe.select("text", predict_language(model, probe).alias("p")).collect()
    assert [r["p"]["lang_pred"] for r in got[:5]] == ["en", "de", "und", "und", "und"]
    assert all(0 <= r["p"]["score"] <= 1 for r in got) and len(got) == 6 + len(odd_rows)


def test_words_are_cut_per_language(frame, monkeypatch):
    own = {f"{x}{x}": [f"{x}{y}{x}{y}" for y in "aeiouy"] for x in "bcdfghjkz"} | {"rare": ["wowo", "xuxu"]}
    rows = [(100 * i + n, " ".join(ws * 5 + ws[:1]), x) for i, (x, ws) in enumerate(own.items()) if x != "rare" for n in range(20)]
    rows.append((10_000, " ".join(own["rare"]), "rare"))
    taught, fit = [], language.fit_pieces
    monkeypatch.setattr(language, "fit_pieces", lambda pieces, counts: taught.append(counts) or fit(pieces, counts))
    docs = frame(rows)
    model = fit_language_model(docs, PIECES, words_per_language=5)
    assert model.languages == sorted(own) and len(own) == 10
    assert taught == [{w: 1 if x == "rare" else 100 + 20 * (w == ws[0]) for w in ws[:5]} for x, ws in sorted(own.items())]
    got = docs.select("lang", predict_language(model, docs).alias("p")).collect()
    assert [r["p"]["lang_pred"] for r in got] == [r["lang"] for r in got]


def test_without_labels_everything_is_undetermined(frame):
    docs = frame([(1, "word", None), (2, None, "en")])
    model = fit_language_model(docs, PIECES)
    assert [r["p"]["lang_pred"] for r in docs.select(predict_language(model, docs).alias("p")).collect()] == ["und", "und"]
    empty = frame([])
    assert fit_language_model(empty, PIECES).languages == [] and empty.select(predict_language(model, empty)).count() == 0


@pytest.mark.parametrize("kept", [0, 10_000])
def test_table_of_words_does_not_change_scores(kept):
    model = LanguageModel(["a", "b"], [START, "x", "y"], np.array([[0.2, 0.2], [0.7, 0.1], [0.1, 0.7]]))
    texts = pd.Series(["xx xy", "yy y", None, "xx"])
    out = pd.concat(model.predictions([texts, texts], words_at_once=1, words_kept=kept))
    assert list(out["lang_pred"]) == ["a", "b", "und", "a"] * 2


def test_held_out_accuracy(spark):
    from pagemill.llm.queries import catalogue

    got = catalogue.queries["op8_language_id"](spark, "/root/testdata/sf0.001")
    truth = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(truth, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 20
