"""Words and shingles of whole Arrow batches, in numpy.

Words are runs of bytes other than ASCII white space, ASCII capitals in lower case. A word is known by a 64-bit hash, a
shingle by a 64-bit hash of its words' hashes: two different shingles of a pair of documents share one with a chance of
about 1 in 2^64. A null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa

T = TypeVar("T")

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII but letters and digits.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Multipliers of the words of a shingle, by place.
PLACES = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)

def release_memory() -> None:
    """Hand memory that is free again back to the system: workers live on between tasks, beside others of their machine."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 1 << 21:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, with the end of the last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(texts: pa.Array, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, and where each text's words begin (with the end of the last).

    ``gaps`` says which bytes part words.
    """
    raw, bounds = buffers(texts)
    if not len(raw):
        nothing = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), nothing, nothing, np.zeros(len(bounds), np.int64)
    solid = ~gaps[raw]
    opens = np.empty(len(raw), dtype=bool)
    opens[0] = True
    np.logical_not(solid[:-1], out=opens[1:])
    opens[bounds[:-1][bounds[:-1] < len(raw)]] = True
    starts = np.flatnonzero(opens & solid)
    closes = np.empty(len(raw), dtype=bool)
    closes[-1] = True
    np.logical_not(solid[1:], out=closes[:-1])
    closes[bounds[1:][bounds[1:] > 0] - 1] = True
    ends = np.flatnonzero(closes & solid) + 1
    run = np.empty(len(raw) + 1, dtype=np.uint64)
    run[0] = 0
    np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=run[1:])
    value = (run[ends] - run[starts]) * powers(INVERSE, len(raw))[starts]
    value += (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return mix(value), starts, ends, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words within a text, and where each text's runs begin.

    A text of fewer than ``k`` words has its whole sequence as its only run, one without words has none.
    """
    counts = np.diff(at)
    total = np.zeros(max(len(hashes) - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        total += hashes[i : len(hashes) - k + 1 + i] * PLACES[i]
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(bounds[-1], dtype=np.uint64)
    long = np.repeat(counts >= k, runs)
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], runs) + np.repeat(at[:-1], runs)
    out[long] = mix(total[place[long]])
    for text in np.flatnonzero((counts > 0) & (counts < k)):
        own = hashes[at[text] : at[text + 1]]
        out[bounds[text]] = mix((own * PLACES[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, bounds


def lean(parts: Iterable[T]) -> Iterator[T]:
    """The parts of a task, with memory released before the first and after each."""
    release_memory()
    for part in parts:
        yield part
        release_memory()


def batches(texts: pa.Array, most_bytes: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most_bytes`` of text; one long text makes a range of its own."""
    _, bounds = buffers(texts)
    ranges, begin = [], 0
    while begin < len(texts):
        end = int(np.searchsorted(bounds, bounds[begin] + most_bytes, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        ranges.append((begin, end))
        begin = end
    return ranges
