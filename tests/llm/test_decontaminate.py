import random
import time

import numpy as np
import pyarrow as pa
import pytest
from samples import prose

from pagemill.llm.decontaminate import AGREEMENT, PLACES_PER_KEY, RECALL, Items, benchmark_matches, collide, edits_by_end, most_edits, run_words, walk_keys
from pagemill.llm.words import MARKS, words


def own_words(text):
    return "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text or "").split()


def least_edits(text, item):
    """Word edits from the item to the nearest part of the text."""
    above = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        row = [i]
        for j, t in enumerate(text, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (w != t)))
        above = row
    return min(above)


def edited(draw, item, edits):
    item = list(item)
    for _ in range(edits):
        at = draw.randrange(len(item))
        kind = draw.randrange(3)
        if kind == 0:
            item[at] = "other"
        elif kind == 1:
            item.insert(at, "more")
        elif len(item) > 1:
            del item[at]
    return item


def test_edits_of_rows():
    region, item = np.array([[1, 2, 3, 9, 4, 5]], np.uint64), np.array([2, 3, 4], np.uint64)
    assert list(edits_by_end(region, item)[0]) == [3, 3, 2, 1, 1, 1, 2]


def test_runs_that_edits_leave():
    for n in range(1, 80):
        k, edits = run_words(n, 80), most_edits(n, 80)
        pieces = edits + 1
        assert 1 <= k <= -(-(n - edits) // pieces)


def test_keys_of_equal_windows_are_equal_and_recall_is_reached():
    draw, rng = random.Random(2), np.random.default_rng(2)
    found = agree = pairs = 0
    for _ in range(150):
        n = draw.randrange(12, 70)
        item = rng.integers(1, 1 << 62, n).astype(np.uint64)
        assert walk_keys(np.stack([item, item]), 3)[0] == walk_keys(item[None], 3)[0]
        near = np.array(edited(draw, item.tolist(), 0), np.uint64)
        at = draw.sample(range(n), most_edits(n, 80))
        near[at] = 7
        found += collide(near[None], item)[0]
        agree += np.mean([walk_keys(near[None], r)[0] == walk_keys(item[None], r)[0] for r in range(20)])
        pairs += 1
    assert found / pairs >= RECALL - 0.04
    assert (agree / pairs) ** (1 / PLACES_PER_KEY) >= AGREEMENT - 0.05


def test_against_brute_force_with_recall(frame, spark, odd_rows):
    draw = random.Random(11)
    items = [(i, prose(500 + i, draw.randrange(8, 50))) for i in range(15)] + [(90, None), (91, ""), (92, "two words"), (93, prose(500, 8).upper())]
    rows = [(i, t) for i, t, _ in odd_rows if i not in (8, 10)]
    for i in range(90):
        body = prose(900 + i, draw.randrange(0, 120)).split()
        if i % 3:
            item = own_words(draw.choice(items[:15])[1])
            at = draw.randrange(len(body) + 1)
            body[at:at] = edited(draw, item, draw.randrange(len(item) // 5 + 2))
        rows.append((100 + i, "** ".join(body)))
    got = benchmark_matches(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for key, text in rows:
        for number, item in items:
            item = own_words(item)
            if len(item) >= 5 and (least := least_edits(own_words(text), item)) <= most_edits(len(item), 80):
                want[key, number] = least
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in got}
    assert set(found) <= set(want) and len(found) >= 0.95 * len(want) > 40
    assert sum(found[k] == want[k] for k in found) >= 0.97 * len(found)
    assert all(found.get(k) == 0 for k, e in want.items() if e == 0)


def test_short_items_against_brute_force(frame, spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(draw.choices(vocabulary, k=i % 4 + 1))) for i in range(40)] + [(50, "..."), (51, "W1, w2")]
    rows = [(i, "; ".join(draw.choices(vocabulary, k=draw.randrange(0, 40)))) for i in range(60)]
    got = benchmark_matches(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = set()
    for key, text in rows:
        text = own_words(text)
        for number, item in items:
            item = own_words(item)
            places = [j for j in range(len(text) - len(item) + 1) if item and text[j : j + len(item)] == item]
            if places:
                want.add((key, number, 0, len(item), places[0], places[0] + len(item), 1.0))
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 400


@pytest.mark.parametrize("letters", ["天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏", "あいうえおカキクケコさしすせそ漢字", "กขคงจฉชซญดตถทนบปผฝพ"])
@pytest.mark.parametrize("size", [3, 40, 100])
def test_scripts_without_spaces(frame, spark, letters, size):
    draw = random.Random(size)
    item = "".join(draw.choices(letters, k=size))
    near = list(item)
    for at in draw.sample(range(size), size // 10):
        near[at] = "x"
    pad = "".join(draw.choices(letters, k=60))
    rows = [(1, pad + item + pad), (2, pad + "、" + item[: size // 2] + " " + item[size // 2 :] + "。」" + pad), (3, pad + "".join(near) + pad), (4, "".join(draw.choices("한국어" + letters[:2], k=200))), (5, None)]
    got = benchmark_matches(frame(rows), spark.createDataFrame([(7, item + "。")], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["edits"]) for r in got} >= {(1, 0), (2, 0)} and {r["doc_id"] for r in got} == {1, 2, 3}
    assert all(r["item_words"] == size and r["edits"] <= size // 5 for r in got)


def test_repeated_words_take_linear_time():
    items = Items([1, 2], ["same " * 300, "one two three four five six"], 80, 1)
    text = np.concatenate([words(pa.array([t]), MARKS)[0] for t in ("same " * 100_000, "one two three other five six")])
    began = time.time()
    got = items.matches([text, text[:200], text[:50]])
    assert got == [(0, 0, 0, 0, 300), (0, 1, 1, 100_000, 100_006)]
    assert time.time() - began < 20


def test_repeated_words_against_brute_force():
    draw = random.Random(2)
    own = [" ".join(draw.choice(["a", "a", "a", "b"]) for _ in range(draw.randrange(5, 40))) for _ in range(30)]
    texts = [" ".join(draw.choice(["a", "a", "a", "a", "b", "c"]) for _ in range(draw.randrange(0, 120))) for _ in range(30)]
    items = Items(list(range(30)), own, 80, 1)
    got = {(t, i): edits for t, i, edits, _, _ in items.matches([words(pa.array([t]), MARKS)[0] for t in texts])}
    want = {(t, i): e for t, text in enumerate(texts) for i, item in enumerate(own) if (e := least_edits(text.split(), item.split())) <= most_edits(len(item.split()), 80)}
    assert all(want.get(k) == e for k, e in got.items()) and len(got) >= 0.95 * len(want)


def test_best_place_and_long_text():
    item = [f"w{i}" for i in range(20)]
    text = ["pad"] * 50_000 + item[:10] + ["x"] + item[11:] + ["pad"] * 40 + item + ["pad"] * 10
    hashes, _, _, at = words(pa.array([" ".join(text), " ".join(item[:8])]), MARKS)
    block = Items([5], [" ".join(item)], 80, 5)
    assert block.matches([hashes[a:b] for a, b in zip(at[:-1], at[1:])]) == [(0, 0, 0, 50_060, 50_080)]


@pytest.mark.parametrize("rows, items", [([], [(1, "a b c d e f")]), ([(1, "a b c d e f")], [])])
def test_empty_tables(frame, spark, rows, items):
    assert benchmark_matches(frame(rows), spark.createDataFrame(items, "item_id long, text string")).count() == 0
