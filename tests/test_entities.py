import re
import time

import pytest

from pagemill.operators import entities as N

SPAN = "text string, start int, end int, label string, start_token int, end_token int"


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def names(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, label string")


def found(df):
    return sorted((r["id"], r["start"], r["end"], r["text"], r["label"]) for r in df.collect())


def brute_force(texts, entries):
    result = []
    for i, text in enumerate(texts):
        candidates = [
            (m.start(), -len(name), label, name)
            for name, label in entries
            for m in re.finditer(rf"(?<!\w)(?={re.escape(name)}(?!\w))", text or "")
        ]
        covered = 0
        for start, size, label, name in sorted(candidates):
            if start >= covered:
                covered = start - size
                result.append((i, start, covered, name, label))
    return sorted(result)


def test_sentence(spark):
    text = "Lumenor sold its A.B.C mill to Fennick & Co. for two boats"
    spans = N.tag_entities(docs(spark, text), "id", "text", names(spark, ("Lumenor", "ORG"), ("A.B.C", "GPE")))
    assert found(N.with_label(spans, "ORG")) == [(0, 0, 7, "Lumenor", "ORG")]
    assert found(spans)[1] == (0, 17, 22, "A.B.C", "GPE")


def test_override_adds_a_missing_span(spark):
    text = "zq wants one more head gardener for its north orchards"
    spans = N.tag_entities(docs(spark, text), "id", "text", names(spark, ("head gardener", "TITLE"), ("north orchards", "X")))
    extra = N.tag_entities(docs(spark, text), "id", "text", names(spark, ("zq", "ORG"), ("gardener for", "Y")))
    merged = N.override_spans(spans, extra, ["id"])
    assert found(merged) == [(0, 0, 2, "zq", "ORG"), (0, 23, 35, "gardener for", "Y"), (0, 40, 54, "north orchards", "X")]
    zq = merged.filter("text = 'zq'").first()
    assert (zq["start_token"], zq["end_token"], zq["label"]) == (0, 1, "ORG")


def test_complete_list_replaces_the_spans_of_its_text(spark):
    texts = docs(spark, "aa bb cc", "aa bb", "cc")
    spans = N.tag_entities(texts, "id", "text", names(spark, ("aa", "1"), ("cc", "1")))
    complete = N.tag_entities(texts.filter("id = 0"), "id", "text", names(spark, ("bb", "2")))
    assert found(N.replace_spans(spans, complete, ["id"])) == [(0, 3, 5, "bb", "2"), (1, 0, 2, "aa", "1"), (2, 0, 2, "cc", "1")]


def test_names_with_symbols(spark):
    text = "we use .NET and $AAPL and Yahoo! daily, asp.NET too; .NETs US$AAPL"
    spans = N.tag_entities(docs(spark, text), "id", "text", names(spark, (".NET", "P"), ("$AAPL", "ORG"), ("Yahoo!", "ORG"), ("!!", "X"), (None, "X")))
    assert [(s, t) for _, s, _, t, _ in found(spans)] == [(7, ".NET"), (16, "$AAPL"), (26, "Yahoo!"), (43, ".NET"), (text.rindex("$AAPL"), "$AAPL")]
    assert N.unmatchable_names(names(spark, (".NET", "P"), ("!!", "X"), (None, "X"))).count() == 2


def test_long_text_takes_linear_time(spark):
    entries = names(spark, ("w", "1"), ("w w", "2"), ("end", "3"))
    short, long = "w x " * 10_000, "w x " * 100_000 + "end"
    N.tag_entities(docs(spark, short), "id", "text", entries).count()
    began = time.time()
    spans = N.tag_entities(docs(spark, long), "id", "text", entries)
    assert spans.count() == 100_001 and time.time() - began < 10


@pytest.mark.parametrize("block", [N.BLOCK_BYTES, 100])
def test_spans_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK_BYTES", block)
    texts = [
        "a b a b c. a-b, (a b c) a b",
        "été a b’c été été_a b",
        "",
        None,
        "ab a\nb a  b",
        "a b c a b c a b " * 50,
        "c++ is c++; c",
        ", a b",
    ]
    entries = [("a b", "1"), ("b c", "2"), ("a b c a", "3"), ("été", "4"), ("c", "5"), ("c++", "6")]
    spans = N.tag_entities(docs(spark, *texts), "id", "text", names(spark, *entries))
    expected = brute_force(texts, entries)
    assert found(spans) == expected and len(expected) > 100


def test_company_of_question(spark):
    questions = docs(spark, "tell me what vortel makes before i sign the QRS", "nothing here", "QRS or vortel mills or vortel")
    entries = names(spark, ("vortel", "ORG"), ("vortel mills", "ORG"), ("QRS", "X"))
    rows = N.company_of_question(questions, ["id"], "text", entries).collect()
    assert sorted((r["id"], r["company"]) for r in rows) == [(0, "vortel"), (2, "vortel mills")]


def test_without_names(spark):
    assert N.tag_entities(docs(spark, "a b"), "id", "text", names(spark, ("!!", "X"))).count() == 0


def test_words_are_cut_in_batches_of_texts():
    """Texts meet nowhere, whatever they begin or end with; offsets and tokens are those of the text."""
    block = N.Names([("aa", "1"), ("aa bb", "2"), (".bb", "3"), ("é" * 70, "4"), ("\U0001d7d8x", "5")])
    texts = ["", "aa", "bb aa", "", "\n", "aa bb", "\U0001f600 .bb x\u0301aa aa", "é" * 70 + " \U0001d7d8x", "é" * 69, ""]
    found = {row: [(s[0], -s[1], s[3], s[4], s[5]) for s in spans] for row, spans in block.candidates(texts)}
    assert found == {
        1: [(0, 2, "aa", 0, 1)],
        2: [(3, 5, "aa", 1, 2)],
        5: [(0, 5, "aa bb", 0, 2), (0, 2, "aa", 0, 1)],
        6: [(2, 5, ".bb", 0, 1), (11, 13, "aa", 2, 3)],
        7: [(0, 70, "é" * 70, 0, 1), (71, 73, "\U0001d7d8x", 1, 2)],
    }
    assert list(block.candidates([])) == list(block.candidates([""])) == list(N.Names([]).candidates(["aa"])) == []


def test_complete_spans_are_found_once(spark):
    """What fills two places of the plan is not computed in both."""
    texts = docs(spark, "aa bb cc", "aa bb", "cc")
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    complete = N.tag_entities(texts, "id", "text", names(spark, ("bb", "2")))
    counted = complete.mapInArrow(count, complete.schema)
    assert N.replace_spans(N.tag_entities(texts, "id", "text", names(spark, ("cc", "1"))), counted, ["id"]).count() == 3
    assert scans.value == 2
