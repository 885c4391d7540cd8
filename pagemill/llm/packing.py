"""Packing of tokenized texts into sequences of fixed length with little padding.

A text's tokens and an end mark are cut into whole sequences and a rest. Rests wait in a window of bounded size; a
sequence is filled by minimum bin slack: over the multiset of waiting lengths a bitset of reachable sums finds the sum
closest to the capacity, and walking the sums backwards tells how many rests of each length make it.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import batches, lean

#: Waiting tokens of a window, in sequences. The sums of so many rests nearly always reach the capacity itself.
WINDOW_SEQUENCES = 64


def closest_sum(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take (at most ``counts``) so that they sum up as close below ``capacity`` as can be.

    Bit ``s`` of ``reach`` is set where the sum ``s`` can be made. Counts are taken in powers of two, so a length costs
    the logarithm of its count. Longer lengths are preferred. The search ends as soon as the capacity is reached.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            size *= 2
        if reach >> capacity:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + take
            total -= length * take
    return taken


class Packer:
    """Fills sequences from a stream of texts' ids. Pieces: key, start, length, crc, text's tokens, sequence, offset."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.waiting: dict[int, list] = {}
        self.tokens = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield self._piece(key, ids, start, self.capacity, 0)
            self.sequence += 1
        if whole < len(ids):
            self.waiting.setdefault(len(ids) - whole, []).append((key, ids[whole:].copy(), whole, len(ids)))
            self.tokens += len(ids) - whole
        while self.tokens >= WINDOW_SEQUENCES * self.capacity:
            yield from self._fill()

    def _piece(self, key, ids: np.ndarray, start: int, length: int, offset: int, before: int = 0, total: int | None = None) -> tuple:
        crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
        return key, start + before, length, crc, len(ids) if total is None else total, self.sequence, offset

    def _take(self, length: int) -> tuple:
        rest = self.waiting[length].pop()
        if not self.waiting[length]:
            del self.waiting[length]
        return rest

    def _fill(self) -> Iterator[tuple]:
        """One whole sequence. Where no sum of rests is the capacity, the longest rest left is cut to fill the slack."""
        offset = 0
        for length, count in closest_sum({n: len(x) for n, x in self.waiting.items()}, self.capacity).items():
            for _ in range(count):
                key, ids, before, total = self._take(length)
                yield self._piece(key, ids, 0, length, offset, before, total)
                offset += length
        slack = self.capacity - offset
        if slack:
            key, ids, before, total = self._take(max(self.waiting))
            yield self._piece(key, ids, 0, slack, offset, before, total)
            self.waiting.setdefault(len(ids) - slack, []).append((key, ids[slack:], before + slack, total))
        self.tokens -= self.capacity
        self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        """Sequences while the capacity can be filled; what is left is cut into sequences of powers of two, which need no padding."""
        while self.tokens >= self.capacity:
            yield from self._fill()
        room = offset = 0
        for _, rests in sorted(self.waiting.items(), reverse=True):
            for key, ids, before, total in rests:
                start = 0
                while start < len(ids):
                    if offset == room:
                        self.sequence += room > 0
                        room, offset = 1 << (self.tokens.bit_length() - 1), 0
                    length = min(len(ids) - start, room - offset)
                    yield self._piece(key, ids, start, length, offset, before, total)
                    start, offset, self.tokens = start + length, offset + length, self.tokens - length
        self.waiting = {}


#: Words of these characters only are what normalisation leaves alone but for capitals, and hold no special token.
PLAIN = re.compile(r"[\x21-\x3b\x3d-\x7e\xa1-\u012f\u0131-\u017f]+")
#: The tokenizer's own cut into units, for such words in lower case.
UNITS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f0-9\xb2\xb3\xb9\xbc-\xbe]+"
)


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte that prints as itself, all others in order from the 256th character on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) if b in prints else chr(256 + others.index(b)) for b in range(256)}


class Table(dict):
    """A dictionary that computes what it lacks."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        self[key] = value = self.compute(key)
        return value


class TextIds:
    """Ids of texts by a public word tokenizer that drops white space, with tables of the words and units met so far."""

    def __init__(self, path: str, most_words: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most_words = Tokenizer.from_file(path), most_words
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.words, self.units = Table(self.word), Table(self.unit)

    def unit(self, unit: str) -> bytes:
        written = unit if unit.isascii() else "".join(map(self.letters.__getitem__, unit.encode()))
        return array("H", [token.id for token in self.model.tokenize(written)]).tobytes()

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text):
            return b"".join(map(self.units.__getitem__, UNITS.findall(text.lower())))
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str], end_id: int) -> Iterator[np.ndarray]:
        if len(self.words) > self.most_words:
            self.words.clear()
            self.units.clear()
        end, ids_of = array("H", [end_id]).tobytes(), self.words.__getitem__
        for text in texts:  # cut at ASCII white space, which no token crosses
            yield np.frombuffer(b"".join(map(ids_of, text.encode().split())) + end, np.uint16)


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``; every id of every text is in exactly one.

    A null or empty text is its end mark alone. Rows that repeat a key are packed each on their own. Every task packs the
    texts that it reads and numbers its sequences after its partition, so nothing is shuffled and a lost task repeats to
    the same pieces. Only the last sequences of a task are shorter than ``capacity``, and those are powers of two.
    """

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, packer = TextIds(tokenizer_path), Packer(capacity, TaskContext.get().partitionId() << 40)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = zip(*pieces, strict=True) if pieces else [[]] * 7
            return pa.record_batch([pa.array(list(c), pa.int64()) for c in columns], [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for part in lean(parts):
            for a, b in batches(part.column(1)):
                keys, texts = part.column(0).slice(a, b - a).to_pylist(), part.column(1).slice(a, b - a).fill_null("").to_pylist()
                yield rows([piece for k, ids in zip(keys, ids_of(texts, end_id), strict=True) for piece in packer.add(k, ids)])
        yield rows(list(packer.finish()))

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(packed, f"{key} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
