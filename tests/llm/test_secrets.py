import random
import string

from samples import prose

from pagemill.llm.queries import PIECES
from pagemill.llm.secrets import candidates, dictionary, scan_secrets

HEX = "0123456789abcdef"


def planted(n):
    draw = random.Random(8)
    rows, secrets = [], set()
    for i in range(n):
        own = prose(i, 40).split() + ["internationalizations", "/usr/local/share/something/else", "counterrevolutionaries"]
        draw.shuffle(own)
        kind = i % 4
        if kind == 0:
            value = "AKIA" + "".join(draw.choice(string.ascii_uppercase + string.digits) for _ in range(16))
            own.insert(draw.randrange(len(own)), value)
        elif kind == 1:
            value = "".join(draw.choice(HEX) for _ in range(18))
            own.insert(draw.randrange(len(own)), "password=" + value)
        elif kind == 2:
            value = "".join(draw.choice(HEX) for _ in range(40))
            own.insert(draw.randrange(len(own)), f'token = "{value}"')
        if kind < 3:
            secrets.add((i, value))
        rows.append((i, " ".join(own)))
    return rows, secrets


def test_planted_secrets_and_nothing_else(frame):
    rows, secrets = planted(200)
    got = scan_secrets(frame(rows), dictionary(PIECES)).collect()
    found = {(r["doc_id"], r["value"]) for r in got}
    assert len(secrets & found) >= 0.97 * len(secrets) and len(found - secrets) <= 0.03 * len(secrets)
    text = dict(rows)
    for r in got:
        word = text[r["doc_id"]].split()[r["word_no"]]
        assert word[r["start"] - 1 :].startswith(r["value"]) and r["n_chars"] == len(r["value"])


def test_candidates_with_their_words(frame):
    got = candidates(frame([(1, 'see  key = "abcdefgh12345678ijkl", ok\npwd:hunter22 end'), (2, None), (3, "short")]), "doc_id", "text").collect()
    assert [(r["id"], r["word_no"], r["before"], r["after"], r["value"]) for r in got] == [(1, 3, "key =", "ok", "abcdefgh12345678ijkl"), (1, 5, '"abcdefgh12345678ijkl", ok', "end", "hunter22")]


def test_odd_rows(frame, odd_rows):
    assert scan_secrets(frame(odd_rows), dictionary(PIECES)).count() == 0
    key = "AKIA" + "Q7" * 8
    got = scan_secrets(frame([(5, key), (5, key), (None, f"x {key} y")]), dictionary(PIECES)).collect()
    assert sorted((str(r["doc_id"]), r["word_no"], r["score"]) for r in got) == [("5", 0, 1.0), ("5", 0, 1.0), ("None", 1, 1.0)]
    assert scan_secrets(frame([]), dictionary(PIECES)).count() == 0
