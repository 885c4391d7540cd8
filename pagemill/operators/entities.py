"""Entity spans from a dictionary ``(name, label)``, overrides, and the company a question is about.

A name matches where it neither begins nor ends inside a word. Offsets count characters, ``end`` exclusive; token offsets
count words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.session import written

WORD = r"[\p{L}\p{M}\p{N}_]"
WORDS = regex.compile(f"{WORD}+")
SPAN = ["text", "start", "end", "label", "start_token", "end_token"]
SPAN_SCHEMA = "text string, start int, end int, label string, start_token int, end_token int"
#: The dictionary is searched in blocks of at most so many bytes of names, each sent to the tasks.
BLOCK_BYTES = 32 << 20

Span = tuple[int, int, str, str, int, int]


class Names:
    """A block of the dictionary: names by their first word, with the symbols before it."""

    def __init__(self, entries: list[tuple[str, str]]):
        self.entries: dict[str, dict[tuple[int, int], dict[str, tuple[int, list[str]]]]] = {}
        for name, label in sorted(set(entries)):
            words = list(WORDS.finditer(name))
            sizes = self.entries.setdefault(words[0].group(), {})
            known = sizes.setdefault((words[0].start(), len(name)), {})
            known.setdefault(name, (len(words), []))[1].append(label)

        self.looks = np.unique(_looks(*(np.array([f(w) for w in self.entries], np.int64) for f in (lambda w: ord(w[0]), len))))

    def candidates(self, texts: list[str]) -> Iterator[tuple[int, list[Span]]]:
        """Texts with names, by number: ``(start, -end, label, name, start_token, end_token)`` of every place of every name, sorted.

        Words are cut in all texts at once; only those that look like the first word of a name are looked up.
        """
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
        inside = _word_codes()[codes]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        starts = np.append([0], starts) if inside[:1].any() else starts
        ends = np.append(np.flatnonzero(inside[:-1] & ~inside[1:]) + 1, [len(codes)])[: len(starts)]
        likely = np.flatnonzero(np.isin(_looks(codes[starts].astype(np.int64), ends - starts), self.looks))
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        rows = np.searchsorted(begins, starts[likely], "right") - 1
        tokens = likely - np.searchsorted(starts, begins)[rows]
        places = zip(rows.tolist(), (starts[likely] - begins[rows]).tolist(), (ends[likely] - begins[rows]).tolist(), tokens.tolist(), strict=True)
        for row, words in groupby(places, itemgetter(0)):
            text, found = texts[row], []
            for _, at, end, token in words:
                for (before, size), names in self.entries.get(text[at:end], {}).items():
                    start = at - before
                    name = text[start : start + size] if start >= 0 else ""
                    if name in names and not (WORDS.match(name[-1]) and WORDS.match(text[start + size : start + size + 1])):
                        n_words, labels = names[name]
                        found += [(start, -start - size, label, name, token, token + n_words) for label in labels]
            if found:
                yield row, sorted(found)


@cache
def _word_codes() -> np.ndarray:
    """Which code points stand in words."""
    every = np.setdiff1d(np.arange(0x110000), np.arange(0xD800, 0xE000)).astype(np.uint32)
    known = np.zeros(0x110000, bool)
    known[np.frombuffer("".join(WORDS.findall(every.tobytes().decode("utf-32-le"))).encode("utf-32-le"), np.uint32)] = True
    return known


def _looks(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A word's first code point and its length, in one number."""
    return first * 64 + np.minimum(length, 63)


def unmatchable_names(names: DataFrame) -> DataFrame:
    """The names that no text can match, as they hold no word."""
    return names.filter(F.col("name").isNull() | ~F.col("name").rlike(WORD))


def _blocks(names: DataFrame) -> Iterator[Names]:
    entries, size = [], 0
    for name, label in names.filter(F.col("name").rlike(WORD)).select("name", "label").distinct().toLocalIterator():
        entries.append((name, label or ""))
        size += len(name.encode()) + 64
        if size >= BLOCK_BYTES:
            yield Names(entries)
            entries, size = [], 0
    if entries:
        yield Names(entries)


def tag_entities(documents: DataFrame, key: str | list[str], text: str, names: DataFrame) -> DataFrame:
    """Non-overlapping spans ``(key, text, start, end, label, start_token, end_token)``, leftmost longest first.

    Words are cut in batches of texts where they are, once per block of the dictionary. Spans of a dictionary of one block
    are chosen in the same pass; those of several blocks meet in a sort per text.
    """
    spark, keys = documents.sparkSession, [key] if isinstance(key, str) else list(key)
    types = dict(documents.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), SPAN_SCHEMA])
    shared = [spark.sparkContext.broadcast(block) for block in _blocks(names)]
    if not shared:
        return spark.createDataFrame([], schema)

    def scan(block, choose: bool) -> DataFrame:
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, spans = [], []
                texts = [body or "" for body in batch.column(len(keys)).to_pylist()]
                for row, candidates in block.value.candidates(texts):
                    covered = 0
                    for span in candidates:
                        if not choose or span[0] >= covered:
                            covered = -span[1]
                            rows.append(row)
                            spans.append(span)
                yield _span_batch(batch, rows, spans, keys)

        return documents.select(*keys, text).mapInArrow(found, schema)

    if len(shared) == 1:
        return scan(shared[0], choose=True)
    every = scan(shared[0], choose=False)
    for block in shared[1:]:
        every = every.union(scan(block, choose=False))
    return leftmost_longest(every, keys)


def _span_batch(batch: pa.RecordBatch, rows: list[int], spans: list[Span], keys: list[str]) -> pa.RecordBatch:
    at = pa.array(rows, pa.int64())
    columns = [batch.column(i).take(at) for i in range(len(keys))]
    columns += [pa.array([s[3] for s in spans], pa.string()), pa.array([s[0] for s in spans], pa.int32()), pa.array([-s[1] for s in spans], pa.int32())]
    columns += [pa.array([s[2] for s in spans], pa.string()), pa.array([s[4] for s in spans], pa.int32()), pa.array([s[5] for s in spans], pa.int32())]
    return pa.RecordBatch.from_arrays(columns, [*keys, *SPAN])


def leftmost_longest(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Keep spans from left to right, the longest at each start, skipping what a kept span covers.

    The spans of a text come sorted and are passed over once; a task holds no more than a batch of them.
    """
    ordered = spans.repartition(*keys).sortWithinPartitions(*keys, "start", F.desc("end"), "label")
    start, end = spans.columns.index("start"), spans.columns.index("end")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, covered = None, 0
        for batch in batches:
            keep = []
            names = zip(*(batch.column(batch.schema.names.index(k)).to_pylist() for k in keys), strict=True)
            for of, a, b in zip(names, batch.column(start).to_pylist(), batch.column(end).to_pylist(), strict=True):
                if of != own:
                    own, covered = of, 0
                keep.append(a >= covered)
                covered = b if a >= covered else covered
            yield batch.filter(pa.array(keep, pa.bool_()))

    return ordered.mapInArrow(kept, spans.schema)


def with_label(spans: DataFrame, label: str) -> DataFrame:
    return spans.filter(F.col("label") == label)


def override_spans(spans: DataFrame, overrides: DataFrame, keys: list[str]) -> DataFrame:
    """Overrides win: a span that overlaps one goes, all others stay unmodified.

    Overlap is found by a sort per text and running bounds, not by pairing spans.
    """
    both = spans.select(*keys, *SPAN, F.lit(False).alias("_override")).unionByName(
        overrides.select(*keys, *SPAN, F.lit(True).alias("_override"))
    )
    order = Window.partitionBy(*keys).orderBy("start")
    earlier = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    later = order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    bounded = both.withColumn("_before", F.max(F.when(F.col("_override"), F.col("end"))).over(earlier)).withColumn(
        "_after", F.min(F.when(F.col("_override"), F.col("start"))).over(later)
    )
    overlaps = F.coalesce(F.col("_before") > F.col("start"), F.lit(False)) | F.coalesce(
        F.col("_after") < F.col("end"), F.lit(False)
    )
    return bounded.filter(F.col("_override") | ~overlaps).select(*keys, *SPAN)


def replace_spans(spans: DataFrame, complete: DataFrame, keys: list[str]) -> DataFrame:
    """A text with rows in ``complete`` has exactly these spans; the spans of all other texts stay.

    ``complete`` is used twice and is written before.
    """
    complete = written(complete.select(*keys, *SPAN), "complete-spans")
    listed = complete.select(*keys).distinct()
    return spans.join(listed, keys, "left_anti").select(*keys, *SPAN).unionByName(complete)


def company_of_question(
    questions: DataFrame, keys: list[str], text: str, names: DataFrame, label: str = "ORG"
) -> DataFrame:
    """``(keys, company)``: the first organisation named in each question."""
    spans = with_label(tag_entities(questions, keys, text, names), label)
    first = F.min(F.struct("start", "text")).alias("first")
    return spans.groupBy(*keys).agg(first).select(*keys, F.col("first.text").alias("company"))
