"""Fill-in-middle against plain slicing of strings, and round trips."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from pagemill.llm.fill_middle import ExcessIndex, fill_in_middle, restored
from pagemill.llm.words import buffers
from pyspark.sql import functions as F


def plain(key, text, salt="1:"):
    text = text or ""
    digest = hashlib.sha256(f"{salt}{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(made, rows):
    got = made.withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    tell = lambda x: (x[0] is None, x[0] or 0, *map(str, x[1:]))
    assert sorted((tuple(r)[:6] for r in got), key=tell) == sorted(((k, *plain(k, t)) for k, t in rows), key=tell)
    assert sorted(r["again"] for r in got) == sorted(t or "" for _, t in rows)


def test_plain_slices(spark, frame, odd_rows):
    rows = [r[:2] for r in odd_rows]
    rows += [(100 + i, t) for i, t in enumerate(["a<P>b", "<S>", "x<M", "<", "<<", "P>", "<P<S<M", "é", "漢字" * 40, "😀a" * 50, "a😀é漢" * 999])]
    rows += [(1000 + i, "naïve café 漢字 😀 <P " * (i % 7)) for i in range(200)]
    made = fill_in_middle(frame(rows))
    check(made, rows)
    assert {r["form"] for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_empty_table(frame):
    assert fill_in_middle(frame([])).collect() == []


def test_shares_are_parameters(frame):
    rows = [(i, "some text") for i in range(50)]
    assert {r["form"] for r in fill_in_middle(frame(rows), plain_percent=0, suffix_first_percent=100).collect()} == {"spm"}
    assert {r["form"] for r in fill_in_middle(frame(rows), plain_percent=100).collect()} == {"plain"}


@given(st.lists(st.text(max_size=30), min_size=1, max_size=8), st.integers(0, 10**6))
def test_index_converts_every_cut(texts, seed):
    raw, bounds = buffers(pa.array(texts))
    index = ExcessIndex(raw, bounds)
    assert index.lengths().tolist() == [len(t) for t in texts]
    cut = np.random.default_rng(seed).integers(0, index.lengths() + 1)
    assert (index.byte_of(cut) - bounds[:-1]).tolist() == [len(t[:c].encode()) for t, c in zip(texts, cut)]
    assert len(index.place) == sum(ord(c) > 127 for t in texts for c in t)
