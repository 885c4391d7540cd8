import random

import pytest

from pagemill.llm.queries import PIECES
from pagemill.llm.token_counts import START, UNKNOWN, LongestMatch, count_tokens, vocabulary


def greedy(word, pieces):
    rest, first, n = word, True, 0
    while rest or first:
        string = (START if first else "") + rest
        end = next((e for e in range(len(string), 0, -1) if string[:e] in pieces and (first or START not in string[:e])), None)
        if end is None:
            return UNKNOWN + 1
        rest, first, n = string[end:], False, n + 1
    return n


@pytest.mark.parametrize("seed", range(20))
def test_automaton_against_greedy_pieces(seed):
    draw = random.Random(seed)
    pieces = {START * draw.randrange(2) + "".join(draw.choice("abc") for _ in range(draw.randrange(1, 6))) for _ in range(12)} | {START, "a", "b"}
    match = LongestMatch(pieces)
    for _ in range(300):
        word = "".join(draw.choice("aaabbc") for _ in range(draw.randrange(1, 14)))
        assert match.count(word) == greedy(word, pieces), (word, pieces)


def test_documents(frame, odd_rows):
    pieces = set(vocabulary(PIECES))
    got = {str(r["doc_id"]) + str(r["n_words"]): r for r in count_tokens(frame(odd_rows), PIECES).collect()}
    for key, text, _ in odd_rows:
        own = (text or "").encode().split()
        row = got[str(key) + str(len(own))]
        counts = [greedy(w.decode(), pieces) for w in own] if len(own) < 1000 and len(text or "") < 1000 else None
        if counts is not None:
            assert (row["n_tokens"], row["n_unknown"]) == (sum(c % UNKNOWN for c in counts), sum(c // UNKNOWN for c in counts))
    assert count_tokens(frame([]), PIECES).count() == 0
