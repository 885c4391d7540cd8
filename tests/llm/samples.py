"""Invented prose for the tests."""

import random

WORDS = [a + b for a in ("ta", "ro", "min", "sel", "vor", "ka", "lun", "bre") for b in ("da", "ne", "stu", "xi", "po", "lar", "gem", "wi")]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", "."]) for _ in range(n))
