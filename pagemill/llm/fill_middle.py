"""Fill-in-middle transformation: a text is cut twice and its middle moved to the end, behind marks.

Cuts are drawn in characters (code points), texts are held in bytes. A sparse index of exceptions converts between them:
it records only where characters of several bytes stand and how many bytes they have beyond one, so that a binary search
in it converts a cut and spans of ASCII are plain arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import batches, buffers, lean

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


class ExcessIndex:
    """Characters of several bytes of some texts: their places in characters, and the bytes that they add up to."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray):
        leads = np.flatnonzero(raw >= 0xC0)
        extra = 1 + (raw[leads] >= 0xE0).astype(np.int64) + (raw[leads] >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.place = leads - self.excess[:-1]
        self.first = bounds - self.excess[np.searchsorted(leads, bounds)]

    def lengths(self) -> np.ndarray:
        """Characters of each text."""
        return np.diff(self.first)

    def byte_of(self, cut: np.ndarray) -> np.ndarray:
        """The byte where character ``cut`` of each text begins; of its end, the end."""
        character = self.first[:-1] + cut
        return character + self.excess[np.searchsorted(self.place, character)]


def draws(key: Column, salt: str) -> list[Column]:
    """Four unsigned 32-bit numbers: the first digits of the sha256 of the salt and the key as text (null: no text)."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw_{i + 1}") for i in range(4)]


def _texts(pieces: list[bytes | memoryview], ends: list[int]) -> pa.Array:
    """Strings from their pieces in order and the number of pieces up to the end of each."""
    sizes = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    offsets = sizes[np.concatenate([[0], np.array(ends, np.int64)])].astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(b"".join(pieces)))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", salt: str = "1:", plain_percent: int = 10, suffix_first_percent: int = 20) -> DataFrame:
    """Per row: key, ``n`` (characters), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    Of the key's draws the first two, modulo ``n + 1``, are the cuts; the third leaves ``plain_percent`` of the texts as
    they are, the fourth puts the suffix first in ``suffix_first_percent`` of the others. A text is also plain, with
    null lengths, if it is empty, null (output: empty) or holds a mark. Rows with one key get the same draws; a null key
    has the draws of an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(F.col(text), F.lit(""))
    marked = reduce(Column.__or__, [F.contains(content, F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def transformed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(1)):
                piece = part.slice(a, b - a)
                raw, bounds = buffers(piece.column(1))
                index = ExcessIndex(raw, bounds)
                n = index.lengths()
                one, two, three, four = (piece.column(i).to_numpy() for i in range(3, 7))
                plain = piece.column(2).to_numpy(zero_copy_only=False) | (n == 0) | (three % 100 >= 100 - plain_percent)
                swapped = four % 100 < suffix_first_percent
                low, high = np.minimum(one % (n + 1), two % (n + 1)), np.maximum(one % (n + 1), two % (n + 1))
                data, cuts = raw.tobytes(), zip(bounds[:-1].tolist(), index.byte_of(low).tolist(), index.byte_of(high).tolist(), bounds[1:].tolist(), strict=True)
                pieces, ends = [], []
                for (start, p, m, end), whole, spm in zip(cuts, plain.tolist(), swapped.tolist(), strict=True):
                    if whole:
                        pieces.append(data[start:end])
                    else:
                        sides = [(marks[0], data[start:p]), (marks[1], data[m:end])]
                        for mark, side in (*(reversed(sides) if spm else sides), (marks[2], data[p:m])):
                            pieces += [mark, side]
                    ends.append(len(pieces))
                form = np.where(plain, PLAIN, np.where(swapped, SUFFIX_FIRST, PREFIX_FIRST))
                yield pa.record_batch(
                    [piece.column(0), pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(low, mask=plain), pa.array(high - low, mask=plain), _texts(pieces, ends)],
                    ["key", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col(key), content.alias("content"), marked.alias("marked"), *draws(F.col(key), salt))
    out = rows.mapInArrow(transformed, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made an output of; no mark can stand across the seam of two parts."""
    part = F.split(output, "<[PSM]>", -1)
    whole = F.when(form == PREFIX_FIRST, F.concat(part[1], part[3], part[2])).when(form == SUFFIX_FIRST, F.concat(part[2], part[3], part[1]))
    return F.coalesce(whole, output)
