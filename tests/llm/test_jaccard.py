import random
from collections import defaultdict

import pyarrow as pa
import pytest
from samples import prose

from pagemill.llm.jaccard import components, jaccard_components, prefix_size, shingle_sets
from pagemill.llm.words import words



def shingles(text):
    own = (text or "").encode().lower().split()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())


def by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least[find(i)], key)
    return sorted((str(k), len(s), least[find(i)] if least[find(i)] < 1 << 60 else None) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def result(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in frame.collect())


def test_words_and_shingles_of_a_batch():
    texts = pa.array(["A b\tC", None, "", " x ", "a b c d e f"]).slice(0, 5)
    hashes, starts, ends, at = words(texts)
    assert list(at) == [0, 3, 3, 3, 4, 10]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[5] and len(set(hashes)) == 7
    assert [len(s) for s in shingle_sets(texts, 5)] == [1, 0, 0, 1, 2]
    assert [len(s) for s in shingle_sets(texts.slice(3, 2), 5)] == [1, 2]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 100, 101])
def test_prefix_meets_every_partner(n):
    need = next(o for o in range(n + 1) if 100 * o >= 80 * n)
    assert prefix_size(n, 80) == n - need + 1


def test_against_brute_force(frame, odd_rows):
    draw = random.Random(5)
    rows = [(i, t) for i, t, _ in odd_rows if i is None or i not in (8, 10)]
    for base in range(12):
        own = prose(100 + base, draw.randrange(20, 120)).split()
        for copy in range(7):
            changed = [w if draw.random() > 0.01 * copy else "new" + str(draw.randrange(9)) for w in own]
            rows.append((1000 + 10 * base + copy, " ".join(changed[: len(own) - copy * draw.randrange(3)])))
    shared = prose(77, 30)
    rows += [(2000 + i, shared + " " + prose(300 + i, 15)) for i in range(12)]
    assert result(jaccard_components(frame(rows).repartition(3))) == by_brute_force(rows)


def test_large_group_of_near_copies(frame):
    base = prose(9, 150).split()
    rows = [(i, " ".join(base[:j] + [f"edit{i}"] + base[j + 1 :])) for i, j in enumerate(random.Random(3).choices(range(150), k=300))]
    got = jaccard_components(frame(rows)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 300


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100}


def test_empty_table(frame):
    got = jaccard_components(frame([]))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0
