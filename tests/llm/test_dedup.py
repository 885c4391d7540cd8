import hashlib
from collections import defaultdict

from pagemill.llm.dedup import exact_duplicates, grown_directory


def test_against_brute_force(frame, odd_rows):
    groups = defaultdict(list)
    for key, text, _ in odd_rows:
        groups[text or ""].append(key)
    want = []
    for text, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        want += [(str(k), keep, len(keys), k == keep, hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    got = exact_duplicates(frame(odd_rows)).collect()
    assert sorted(tuple(map(str, (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]))) for r in got) == sorted(tuple(map(str, w)) for w in want)
    assert {r["chain"] for r in got} == {0}


def test_empty_table(frame):
    assert exact_duplicates(frame([])).count() == 0


def test_directory_doubles_where_buckets_are_full():
    counts = {0: 10, 1: 10, 9: 3, 15: 100}
    directory = grown_directory(counts, 12, bits=4)
    assert [e for e, _, _ in directory] == list(range(16))
    depth = {b: d for _, b, d in directory}
    rows = defaultdict(int)
    for entry, bucket, _ in directory:
        rows[bucket] += counts.get(entry, 0)
    assert all(n <= 12 or depth[b] == 4 for b, n in rows.items())
    assert rows[0] == 10 and rows[1] == 10 and depth[15] == 4


def test_one_bucket_while_nothing_is_full():
    assert {(b, d) for _, b, d in grown_directory({}, 5, bits=3)} == {(0, 0)}
