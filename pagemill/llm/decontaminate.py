"""Benchmark passages in texts, found by embedding edit distance into Hamming distance.

Texts and items are sequences of words (letters, digits and all beyond ASCII, ASCII capitals in lower case; in scripts written
without spaces every character is a word). A window of an item's size is walked through at random: step by step the current word is put out, and a random bit of step and word
says whether to move on. Two sequences of small edit distance, walked with the same bits, agree in most places of the
outcome. Samples of a few places make a key; windows whose key equals the item's in any of many repetitions are
compared exactly. Windows without a run of words that a match cannot do without are passed over; for items of up to four
words, which allow no edits, that run is the whole item and nothing else is asked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import BASE, MARKS, PLACES, batches, buffers, lean, mix, words

#: Chance that a place of a key agrees for a pair at the threshold. Measured 0.56 on average over pairs of 12 to 69 words;
#: pairs differ, and 0.47 gives the number of repetitions that reaches the recall over all of them.
AGREEMENT = 0.47
PLACES_PER_KEY = 3
RECALL = 0.97
#: Items are searched in blocks of at most so many bytes of text, each sent to the tasks.
BLOCK_BYTES = 8 << 20
#: About so many meetings of a text's runs with those of the items are looked at at once.
MET_AT_ONCE = 1 << 21
NO_WORD = np.uint64(0)
#: So many words at most are found by one run alone.
LONGEST_RUN = 4
SCRIPTS = "Han Hiragana Katakana Bopomofo Yi Thai Lao Khmer Myanmar Tibetan Javanese Balinese Tai_Tham Tai_Le New_Tai_Lue Tai_Viet"
#: Characters of scripts without spaces, and the marks of East Asia, which part words as those of ASCII do.
UNSPACED = "([" + "".join(rf"\p{{{x}}}" for x in SCRIPTS.split()) + r"\x{30FC}\x{FF70}])"
WIDE_MARKS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{303D}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"


def most_edits(n: int, percent: int) -> int:
    """Edits that leave ``percent`` per cent of ``n`` words."""
    return n * (100 - percent) // 100


def run_words(n: int, percent: int) -> int:
    """So many words in a row, 4 at most, survive any allowed edits: the rest of ``n`` words falls into one run more than there are edits."""
    edits = most_edits(n, percent)
    return min(LONGEST_RUN, -(-(n - edits) // (edits + 1)))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin (with the end of the last)."""
    raw, _ = buffers(texts)
    if len(raw) and raw.max() >= 0xE0:  # the first byte of the least of these characters
        texts = pc.replace_substring_regex(pc.replace_substring_regex(texts, WIDE_MARKS, " "), UNSPACED, r" \1 ")
    hashes, _, _, at = words(texts, MARKS)
    return hashes, at


def repetitions(recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - AGREEMENT**PLACES_PER_KEY))


def sampled_steps(size: int, repetition: int) -> np.ndarray:
    """The places of a repetition's key among the ``3 size`` of the outcome, of which the last third is mostly padding."""
    return np.sort(np.random.default_rng([size, repetition]).choice(2 * size, min(PLACES_PER_KEY, 2 * size), replace=False))


def walk_keys(windows: np.ndarray, repetition: int) -> np.ndarray:
    """The key of every row of ``windows`` (word hashes, of one size): its random walk, sampled."""
    count, size = windows.shape
    place, rows, key = np.zeros(count, np.int64), np.arange(count), np.zeros(count, np.uint64)
    steps = sampled_steps(size, repetition)
    padded = np.concatenate([windows, np.full((count, 1), NO_WORD, windows.dtype)], axis=1)
    salt = mix(np.arange(steps[-1] + 1, dtype=np.uint64) * PLACES[0] + PLACES[1:2] * np.uint64(repetition + 1))
    for step in range(steps[-1] + 1):
        word = padded[rows, place]
        if step in steps:
            key = mix(key * np.uint64(BASE) + word)
        place = np.minimum(place + ((((word ^ salt[step]) * PLACES[2]) >> np.uint64(63)).astype(np.int64)), size)
    return key


def collide(windows: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which windows share a key with the item in any repetition."""
    hit = np.zeros(len(windows), bool)
    for repetition in range(repetitions()):
        left = np.flatnonzero(~hit)
        if not len(left):
            break
        keys = walk_keys(np.concatenate([windows[left], item[None]]), repetition)
        hit[left] = keys[:-1] == keys[-1]
    return hit


def edits_by_end(regions: np.ndarray, item: np.ndarray) -> np.ndarray:
    """For every row of ``regions`` the least word edits from ``item`` to a part that ends before each column."""
    count, width = regions.shape
    columns = np.arange(width + 1, dtype=np.int32)
    above = np.zeros((count, width + 1), np.int32)
    for i, word in enumerate(item, 1):
        row = np.minimum(above + 1, np.concatenate([np.full((count, 1), i, np.int32), above[:, :-1] + (regions != word)], axis=1))
        above = np.minimum.accumulate(row - columns, axis=1) + columns
    return above


class Items:
    """A block of benchmark items, with an index of the word runs that a match must share."""

    def __init__(self, numbers: list, texts: list[str], percent: int, least_words: int):
        self.percent = percent
        hashes, at = split_words(pa.array(texts, pa.string()))
        own = [(n, hashes[a:b]) for n, a, b in zip(numbers, at[:-1], at[1:], strict=True) if b - a >= max(least_words, 1)]
        self.numbers, self.words = [n for n, _ in own], [w for _, w in own]
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for i, w in enumerate(self.words):
            k = run_words(len(w), percent)
            runs.setdefault(k, []).extend((int(h), i, j) for j, h in enumerate(_runs(w, k)))
        self.runs = {}
        for k, found in runs.items():
            run, item, place = (np.array(x, dtype) for x, dtype in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))
            order = np.argsort(run, kind="stable")
            self.runs[k] = run[order], item[order], place[order]

    def windows(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and starts of the windows of ``text`` that share a needed run with their item, each once."""
        pairs = [np.zeros(0, np.int64)]
        width = len(text) + max(map(len, self.words), default=0)
        for k, (run, item, place) in self.runs.items():
            own = _runs(text, k)
            lo, hi = np.searchsorted(run, own, "left"), np.searchsorted(run, own, "right")
            met = np.flatnonzero(hi > lo)
            many = (hi - lo)[met]
            for part in np.split(np.arange(len(met)), np.flatnonzero(np.diff(np.cumsum(many) // MET_AT_ONCE)) + 1):
                own_many = many[part]
                entry = np.repeat(lo[met[part]], own_many) + np.arange(own_many.sum()) - np.repeat(np.cumsum(own_many) - own_many, own_many)
                start = np.repeat(met[part], own_many) - place[entry] + width - len(text)  # 0 or more
                pairs.append(np.unique(item[entry] * width + start))
        both = np.unique(np.concatenate(pairs))
        return both // width, both % width - (width - len(text))

    def matches(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, edits, first word, end)`` of the best place of every item in every text that holds it.

        Of places with equal edits the one that ends first counts.
        """
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        every = np.concatenate([*texts, np.zeros(0, np.uint64)])
        met = [(i, s + at[t], np.full(len(i), t)) for t, text in enumerate(texts) if len(text) for i, s in [self.windows(text)] if len(i)]
        if not met:
            return []
        item, start, text = (np.concatenate(x) for x in zip(*met, strict=True))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i in np.unique(item):
            own, wanted = np.flatnonzero(item == i), self.words[i]
            slack = most_edits(len(wanted), self.percent)
            if slack == 0 and len(wanted) <= LONGEST_RUN:
                own = own[(_cut(every, at, text[own], start[own], len(wanted)) == wanted).all(axis=1)]
                first = own[np.unique(text[own], return_index=True)[1]]  # starts rise within a text
                best.update(((int(text[x]), int(i)), (0, int(start[x] - at[text[x]]), int(start[x] - at[text[x]]) + len(wanted))) for x in first)
                continue
            for part in np.array_split(own, max(1, len(own) * len(wanted) // 2_000_000)):
                low = start[part] - slack
                regions = _cut(every, at, text[part], low, len(wanted) + 2 * slack)
                _, kind, same = np.unique(np.ascontiguousarray(regions).view(np.dtype((np.void, regions.itemsize * regions.shape[1]))).ravel(), return_index=True, return_inverse=True)
                regions = regions[kind]  # repeated words make many equal ones
                least, end = np.full(len(kind), slack + 1), np.zeros(len(kind), np.int64)
                hit = np.flatnonzero(collide(regions[:, slack : slack + len(wanted)], wanted))
                if len(hit):
                    ends = edits_by_end(regions[hit], wanted)
                    least[hit], end[hit] = ends.min(axis=1), ends.argmin(axis=1)
                least, end = least[same], end[same]
                near = np.flatnonzero(least <= slack)
                near = near[np.lexsort((near, low[near] + end[near], least[near], text[part[near]]))]
                for x in near[np.unique(text[part[near]], return_index=True)[1]]:  # the best of each text
                    t, begin, until = int(text[part[x]]), low[x], end[x]
                    if (t, int(i)) in best and best[t, int(i)][::2] <= (least[x], begin + until - at[t]):
                        continue
                    back = edits_by_end(_cut(every, at, text[part[x : x + 1]], np.array([begin]), until)[:, ::-1], wanted[::-1])[0]
                    best[t, int(i)] = (int(least[x]), int(begin + until - back.argmin() - at[t]), int(begin + until - at[t]))
        return [(t, i, *found) for (t, i), found in sorted(best.items())]


def _runs(hashes: np.ndarray, k: int) -> np.ndarray:
    n = max(len(hashes) - k + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * PLACES[j]
    return mix(total)


def _cut(every: np.ndarray, at: np.ndarray, text: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``size`` words from ``start`` on, without those of other texts."""
    where = start[:, None] + np.arange(size)
    inside = (where >= at[text][:, None]) & (where < at[text + 1][:, None])
    return np.where(inside, every[np.clip(where, 0, len(every) - 1)], NO_WORD)


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of bounded size, one at a time on the driver."""
    numbers, texts, size = [], [], 0
    for number, body in items.select(key, text).filter(F.col(text).isNotNull()).toLocalIterator():
        numbers.append(number)
        texts.append(body)
        size += len(body.encode())
        if size >= block_bytes:
            yield numbers, texts
            numbers, texts, size = [], [], 0
    if numbers:
        yield numbers, texts


def benchmark_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = 80, least_words: int = 1) -> DataFrame:
    """One row per document and item found in it: keys, ``edits``, ``item_words``, ``start_word``, ``end_word``, ``similarity``.

    An item is in a text where some part of the text is at most ``100 - percent`` per cent of the item's words away in
    word edits; the best part is reported. Items under ``least_words`` words, without a word and null ones match nothing, nor
    do null and empty texts. Rows that repeat a key are documents of their own. Documents are scanned once per block of items
    and never shuffled; a task holds one piece of a batch at a time.
    """
    spark = docs.sparkSession
    schema = f"{key} long, {item_key} long, edits int, item_words int, start_word long, end_word long, similarity double"

    def search(shared):
        def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block: Items = shared.value
            for part in lean(parts):
                for a, b in batches(part.column(1)):
                    hashes, at = split_words(part.column(1).slice(a, b - a))
                    rows = block.matches([hashes[x:y] for x, y in zip(at[:-1], at[1:], strict=True)])
                    sizes = [len(block.words[i]) for _, i, *_ in rows]
                    columns = [
                        part.column(0).take(pa.array([a + t for t, *_ in rows], pa.int64())),
                        pa.array([block.numbers[i] for _, i, *_ in rows], pa.int64()),
                        pa.array([e for _, _, e, _, _ in rows], pa.int32()),
                        pa.array(sizes, pa.int32()),
                        pa.array([s for *_, s, _ in rows], pa.int64()),
                        pa.array([e for *_, e in rows], pa.int64()),
                        pa.array([1 - e / n for (_, _, e, _, _), n in zip(rows, sizes, strict=True)], pa.float64()),
                    ]
                    yield pa.record_batch(columns, [key, item_key, "edits", "item_words", "start_word", "end_word", "similarity"])

        return docs.select(F.col(key).cast("long"), text).mapInArrow(found, schema)

    searched = [search(spark.sparkContext.broadcast(Items(*block, percent, least_words))) for block in item_blocks(items, item_key, item_text)]
    return reduce(DataFrame.union, searched) if searched else spark.createDataFrame([], schema)
