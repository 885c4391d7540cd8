import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from pagemill.llm.packing import TextIds, closest_sum, pack_documents
from pagemill.llm.queries import WORD_TOKENIZER


@pytest.mark.parametrize("seed", range(30))
def test_closest_sum_against_all_subsets(seed):
    draw = random.Random(seed)
    counts = {draw.randrange(1, 40): draw.randrange(1, 4) for _ in range(5)}
    capacity = draw.randrange(1, 120)
    taken = closest_sum(counts, capacity)
    assert all(0 < n <= counts[length] for length, n in taken.items())
    best = max(s for ns in itertools.product(*[range(n + 1) for n in counts.values()]) if (s := sum(a * b for a, b in zip(ns, counts))) <= capacity)
    assert sum(a * b for a, b in taken.items()) == best


def test_ids_are_the_tokenizers():
    draw = random.Random(4)
    letters = [chr(c) for c in [*range(9, 0x180), 0x307, 0x3A3, 0x3C2, 0x2028, 0x3000, 0x6F22, 0x1F600, 0xFB01, 0x212B, 0x1E9B]]
    texts = ["".join(draw.choice(letters + [" "] * 60 + list("'stredmvll") * 6) for _ in range(300)) for _ in range(200)]
    texts += ["", "<|endoftext|> a <|startoftext|>", "It's THE end, we'LL <| see|>", "x" * 5000]
    want = Tokenizer.from_file(WORD_TOKENIZER).encode_batch(texts, add_special_tokens=False)
    for ids, w in zip(TextIds(WORD_TOKENIZER)(texts, 2), want, strict=True):
        assert ids.tolist() == [*w.ids, 2]


def test_round_trip(frame, odd_rows):
    rows = [*odd_rows, *[(100 + i, " ".join(["word"] * n)) for i, n in enumerate([0, 1, 4095, 4096, 8191, 700, 700, 3000, 3000])]]
    pieces = pack_documents(frame(rows).repartition(3), WORD_TOKENIZER).collect()
    ids = defaultdict(list)
    for text, e in zip([r[1] for r in rows], Tokenizer.from_file(WORD_TOKENIZER).encode_batch([r[1] or "" for r in rows], add_special_tokens=False)):
        ids[len(e.ids) + 1].append(np.array([*e.ids, 2], "<u4"))
    assert sum(p["length"] for p in pieces) == sum(n * len(x) for n, x in ids.items())
    texts = defaultdict(list)
    for p in pieces:
        texts[str(p["doc_id"]), p["doc_tokens"]].append(p)
        assert any(zlib.crc32(x[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for x in ids[p["doc_tokens"]])
    for (_, n), own in texts.items():
        starts = sorted((p["start"], p["length"]) for p in own)
        assert sum(length for _, length in starts) % n == 0
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end <= 4096 and (end == 4096 or end & (end - 1) == 0 or end > 3900)


def test_empty_table(frame):
    assert pack_documents(frame([]), WORD_TOKENIZER).count() == 0
