"""Token counts by greedy longest match in time linear in the text, without building a token.

The vocabulary is a trie: pieces that begin a word below one root, pieces that go on below another. Every node has a
failure link, to where matching goes on when no edge fits, and the number of tokens that are popped on the way. A word
is one walk along edges and links; the popped numbers add up to its count.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import batches, lean

START = "▁"
#: A sum of words' entries holds tokens below this bit and unknown words from it on.
UNKNOWN = 1 << 40
#: Characters of one word that are walked by the automaton itself; counts of shorter words are kept in a table.
LONG_WORD = 256


def vocabulary(path: str) -> list[str]:
    """Pieces of a public sentencepiece vocabulary, without byte and control pieces; a mark begins those that begin a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [p for p in pieces if START not in p[1:]]


class LongestMatch:
    """Counts the tokens of words. A word that no run of longest matches covers is one unknown token."""

    def __init__(self, pieces: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # the root of words, the root of what goes on
        ends = set()
        for piece in pieces:
            node = 0 if piece.startswith(START) else 1
            for c in piece:
                following = self.edges[node].setdefault(c, len(self.edges))
                if following == len(self.edges):
                    self.edges.append({})
                node = following
            ends.add(node)
        self.fail: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for c, node in self.edges[parent].items():
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = 1, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at is not None and c not in self.edges[at]:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at is not None:
                    self.fail[node], self.popped[node] = self.edges[at][c], popped

    def count(self, word: str) -> int:
        """Tokens of a word, or ``UNKNOWN + 1``."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, tokens = 0, 0
        for c in START + word:
            while c not in edges[node]:
                if fail[node] is None:
                    return UNKNOWN + 1
                tokens += popped[node]
                node = fail[node]
            node = edges[node][c]
        while node != 1:
            if fail[node] is None:
                return UNKNOWN + 1
            tokens += popped[node]
            node = fail[node]
        return tokens


class WordCounts(dict):
    """Entries of the words met so far."""

    def __init__(self, match: LongestMatch):
        super().__init__()
        self.match = match

    def __missing__(self, word: bytes) -> int:
        found = self.match.count(word.decode())
        if len(word) <= LONG_WORD:
            self[word] = found
        return found


def count_tokens(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", most_words: int = 400_000) -> DataFrame:
    """Per row of ``docs``: key, ``n_words`` (between ASCII white space), ``n_tokens``, ``n_unknown`` (words of one unknown token).

    Null and empty texts count 0. Rows that repeat a key are counted each on their own. Row-local: nothing is shuffled,
    and a task holds one piece of a batch and a bounded table of words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCounts(LongestMatch(shared.value))
        for part in lean(parts):
            for a, b in batches(part.column(1)):
                if len(known) > most_words:
                    known.clear()
                split = [text.encode().split() for text in part.column(1).slice(a, b - a).fill_null("").to_pylist()]
                sums = [sum(map(known.__getitem__, words)) for words in split]
                columns = [pa.array(map(len, split), pa.int64()), pa.array([s % UNKNOWN for s in sums], pa.int64()), pa.array([s // UNKNOWN for s in sums], pa.int64())]
                yield pa.record_batch([part.column(0).slice(a, b - a), *columns], [key, "n_words", "n_tokens", "n_unknown"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(counted, f"{key} long, n_words long, n_tokens long, n_unknown long")
