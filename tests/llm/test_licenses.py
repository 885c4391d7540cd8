import random
import re
import time

import pytest

from pagemill.llm.licenses import BASE, MOST_WORDS, rules, scan_licenses, sought

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(CAPITALS))
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


TEXTS = [
    "All rights reserved. Some CC BY-NC 4.0, and CC  BY; cc by cc by",
    "GNU General Public License, version 3 or any later version. All\nRights\treserved",
    "all rights reservedé all rights reserved_ x",
    "cc by",
    "Éall rights reserved all rights all rights reserved",
]


def test_base_columns_against_brute_force(frame, odd_rows):
    rows = [*[(i, t) for i, t, _ in odd_rows], *[(50 + i, t) for i, t in enumerate(TEXTS)], (90, "word cc by " * 3000)]
    got = scan_licenses(frame(rows)).collect()
    columns = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(str((r["doc_id"], *(r[c] for c in columns))) for r in got) == sorted(str((k, *base(t))) for k, t in rows)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        ("Released under the MIT License.", "mit"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3"),
        ("GNU Lesser General Public License version 2.1", "gpl,lgpl-2.1"),
        ("GNU GPL version 2 or any later version", "gpl-2-or-later"),
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
        ("Copyright (c) 2019 Somebody. All rights reserved", "copyright,reserved"),
        ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0"),
        ("a mit of apache gpls", ""),
        ("Redistribution and use in source and binary forms, with or without", "bsd"),
    ],
)
def test_labels(frame, text, labels):
    assert scan_licenses(frame([(1, f"Some words. {text} And more.")])).first()["labels"] == labels


def test_rules_against_a_plain_matcher(frame):
    texts = [*TEXTS, "licensed under the terms of the mozilla public license 2.0 mozilla public license", "cc0 1.0 and spdx license identifier gpl 3 or later"]
    draw = random.Random(6)
    parts = "word licensed under the terms of gnu gpl lgpl general public license version 2 3 0 or any later mit bsd apache cc by nc sa 4 all rights reserved copyright 2020".split()
    texts += [" ".join(draw.choice(parts) for _ in range(400)) for _ in range(4)]
    texts += [" ".join(draw.choice(["x", "licensed under the gnu gpl version 2 or any later version", "gpl", "all rights reserved"]) for _ in range(60))]
    for text, row in zip(texts, sorted(scan_licenses(frame(list(enumerate(texts)))).collect(), key=lambda r: r["doc_id"]), strict=True):
        own = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(CAPITALS))) + " "
        found = []
        for priority, label, _, pattern, _ in rules():
            for m in re.finditer(f"(?<= )(?:{pattern})(?= )", own):
                found.append((own[: m.start()].count(" ") - 1, own[: m.end()].count(" "), priority, label))
        kept = {x for x in found if not any(y[0] <= x[0] and y[1] >= x[1] and (y[2] > x[2] or y[2] == x[2] and y[1] - y[0] > x[1] - x[0]) for y in found)}
        assert {(d["first"], d["end"], d["priority"], d["label"]) for d in row["detections"]} == kept


def test_repeated_matches_take_linear_time(frame):
    scan = scan_licenses(frame([(1, "copyright 2020 word " * 50_000), (2, "gpl " * 50_000)]))
    began = time.time()
    first, second = sorted(scan.collect(), key=lambda r: r["doc_id"])
    assert time.time() - began < 60  # a quadratic form takes hours
    assert [d["first"] for d in first["detections"]] == list(range(0, 150_000, 3)) and len(second["detections"]) == 50_000


def test_no_rule_matches_more_words_than_are_looked_at():
    assert all(pattern.count(" ") + 1 + 6 * pattern.count("{0,6}") < MOST_WORDS for *_, pattern, _ in rules())


def test_rules_are_many_and_gated():
    assert len(rules()) > 300 and all(r[2] for r in rules())
    assert [r[0] for r in rules()] == sorted((r[0] for r in rules()), reverse=True)


def test_empty_table(frame):
    assert scan_licenses(frame([])).count() == 0


def shortest(pattern):
    """Every string of the pattern without its optional parts, the first character of each class."""

    def strings(parsed):
        made = [""]
        for kind, value in parsed:
            if str(kind) == "LITERAL":
                own = [chr(value)]
            elif str(kind) == "IN":
                own = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
            elif str(kind) == "MAX_REPEAT":
                own = strings(value[2]) if value[0] else [""]
            elif str(kind) == "BRANCH":
                own = [x for branch in value[1] for x in strings(branch)]
            else:
                own = strings(value[-1])
            made = [a + b for a in made for b in own]
        return made

    return strings(re._parser.parse(pattern))


def test_keywords_are_in_every_match():
    for _, label, keyword, pattern, _ in rules():
        for text in shortest(pattern):
            assert re.fullmatch(pattern, text) and sought(keyword) in f" {text} ", (label, keyword, text)


def test_rules_fire_without_their_optional_parts(frame):
    own = [(label, shortest(pattern)[0]) for _, label, _, pattern, _ in rules()]
    got = {r["doc_id"]: r for r in scan_licenses(frame([(i, f"x {text} x") for i, (_, text) in enumerate(own)])).collect()}
    for i, (label, text) in enumerate(own):
        assert any(d["first"] <= 1 and d["end"] >= len(text.split()) + 1 for d in got[i]["detections"]), (label, text)


WORDINGS = [
    ("released under the MIT", "mit"),
    ("MIT licence", "mit"),
    ("BSD-style license", "bsd"),
    ("a new BSD licence", "bsd"),
    ("shared under zlib", "zlib"),
    ("ISC licence", "isc"),
    ("GPLv2", "gpl-2"),
    ("GPLv3 or later", "gpl-3-or-later"),
    ("under LGPLv2.1", "lgpl-2.1"),
    ("AGPLv3.0", "agpl-3"),
    ("gplv gpls mit bsd", ""),
]


def test_short_wordings(frame):
    got = {r["doc_id"]: r["labels"] for r in scan_licenses(frame([(i, f"Some words. {text}, and more.") for i, (text, _) in enumerate(WORDINGS)])).collect()}
    assert [(text, got[i]) for i, (text, _) in enumerate(WORDINGS)] == WORDINGS
