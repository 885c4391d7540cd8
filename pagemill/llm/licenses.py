"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words, parted by single spaces. A text with no keyword of any rule is done. For the others every rule
whose keyword occurs is matched as a regular expression on the words; where detections overlap, one that lies within
another's words is dropped if the other has priority, or the same and is longer.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Everything in ASCII but letters and digits parts words.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases that are always reported, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed names of public licenses: label, keyword, words of the name, versions (none: the name alone decides). Every match of
# the name holds the keyword.
FAMILIES = [
    ("apache", "apache", "apache(?: software)?", "1 0|1 1|2 0"),
    ("gpl", "general public", "gnu general public", "1|2|3"),
    ("gpl", "gpl", "(?:gnu )?gpl", "1|2|3"),
    ("lgpl", "general public", "gnu (?:lesser|library) general public", "2|2 1|3"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "2|2 1|3"),
    ("agpl", "affero", "gnu affero general public", "1|3"),
    ("agpl", "agpl", "(?:gnu )?agpl", "1|3"),
    ("gfdl", "free documentation", "gnu free documentation", "1 1|1 2|1 3"),
    ("mpl", "mozilla public", "mozilla public", "1 0|1 1|2 0"),
    ("epl", "eclipse public", "eclipse public", "1 0|2 0"),
    ("cddl", "common development and distribution", "common development and distribution", "1 0|1 1"),
    ("eupl", "european union public", "european union public", "1 0|1 1|1 2"),
    ("osl", "open software", "open software", "1 0|2 0|2 1|3 0"),
    ("afl", "academic free", "academic free", "1 1|1 2|2 0|2 1|3 0"),
    ("artistic", "artistic", "artistic", "1 0|2 0"),
    ("bsl", "boost software", "boost software", "1 0"),
    ("ofl", "open font", "sil open font", "1 0|1 1"),
    ("odbl", "open database", "open database", "1 0"),
    ("odc-by", "open data commons", "open data commons attribution", "1 0"),
    ("psf", "python software foundation", "python software foundation", "2"),
    ("php", "php", "php", "3 0|3 01"),
    ("ecl", "educational community", "educational community", "1 0|2 0"),
    ("cc0", "cc0", "(?:creative commons )?cc0", "1 0"),
    ("cc-by", "cc by", "cc by", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-sa", "cc by sa", "cc by sa", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nc", "cc by nc", "cc by nc", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nd", "cc by nd", "cc by nd", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by", "creative commons", "creative commons attribution", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial", "1 0|2 0|2 5|3 0|4 0"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:ative)?s", "1 0|2 0|2 5|3 0|4 0"),
    ("mit", "mit", "mit", ""),
    ("isc", "isc", "isc", ""),
    ("zlib", "zlib", "zlib", ""),
    ("unlicense", "unlicense", "unlicense", ""),
    ("wtfpl", "do what the fuck you want", "do what the fuck you want to public", ""),
    ("ms-pl", "microsoft public", "microsoft public", ""),
    ("bsd-2-clause", "2 clause", "(?:simplified )?bsd 2 clause", ""),
    ("bsd-3-clause", "3 clause", "(?:new )?bsd 3 clause", ""),
    ("bsd", "bsd", "bsd(?: style)?", ""),
]
# Fixed sentences of public licenses: label, keyword, words.
SENTENCES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy", "permission to use copy modify and or distribute this software"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("gpl", "free software you can", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("zlib", "as is without any express", "provided as is without any express or implied warranty"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("no-redistribution", "may not be", "may not be (?:reproduced|redistributed|copied)(?: [a-z]+){0,6} without (?:prior )?(?:written )?permission"),
]
#: Names that are words or companies too; alone they count only with the word license.
COMMON_NAMES = ("apache", "artistic", "open software", "php", "mit", "isc", "zlib", "bsd")
#: Names that are written in one word with their version, as in GPLv2; a word that begins with one passes the keyword filter.
ABBREVIATED = ("gpl", "lgpl", "agpl")
#: No rule matches more words.
MOST_WORDS = 64
UNDER = "(?:licensed|released|distributed|published|available|provided|shared) under (?:the )?(?:terms of (?:the )?)?"

Rule = tuple[int, str, str, str, float]


@lru_cache
def rules() -> tuple[Rule, ...]:
    """``(priority, label, keyword, pattern, confidence)``, by priority: one family of rules for each name, version and wording."""
    made: list[Rule] = []
    for family, keyword, name, versions in FAMILIES:
        named = rf"{name}(?: licen[cs]e)?"
        made.append((10, family, keyword, rf"{name} licen[cs]e" if name.startswith(COMMON_NAMES) else named, 0.7))
        made.append((20, family, keyword, UNDER + named, 0.85))
        made.append((40, family, "spdx", "spdx license identifier " + name, 0.95))
        for version in versions.split("|") if versions else ():
            label = f"{family}-{version.replace(' ', '.')}"
            gap = " ?" if keyword in ABBREVIATED else " "
            numbered = rf"{named}(?: version)?{gap}v?{version}(?: [0-9]+)?" if " " in version else rf"{named}(?: version)?{gap}v?{version}(?: 0)?"
            made.append((30, label, keyword, numbered, 0.9))
            made.append((35, label, keyword, UNDER + numbered, 0.95))
            made.append((45, label, "spdx", f"spdx license identifier {name} {version}", 1.0))
            made.append((50, f"{label}-or-later", "later", numbered + "(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?", 1.0))
    made += [(25, label, keyword, pattern, 0.9) for label, keyword, pattern in SENTENCES]
    return tuple(sorted(made, key=lambda r: (-r[0], r[1], r[3])))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def sought(keyword: str) -> str:
    """What the words of a text hold if they hold the keyword."""
    return f" {keyword}" if keyword in ABBREVIATED else f" {keyword} "


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _rule_array() -> Column:
    """All rules as one literal array of structs."""
    told = [{"priority": p, "label": label, "keyword": sought(k), "pattern": _bounded(pattern), "confidence": c} for p, label, k, pattern, c in rules()]
    return F.from_json(F.lit(json.dumps(told)), "array<struct<priority:int,label:string,keyword:string,pattern:string,confidence:double>>")


def _running(sizes: Column) -> Column:
    """Running sums of an array: in every pass each entry takes on the one twice as far before it."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sizes) + 1)).cast("int"))

    def doubled(sums: Column, step: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), step)
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(0))

    return F.aggregate(passes, sizes, doubled)


def _places(words: Column, rule: Column) -> Column:
    """Every match of a rule: first word, the word behind the last, and what the rule says."""
    inner = F.transform(F.regexp_extract_all(words, rule["pattern"], F.lit(0)), spaces)
    between = F.slice(F.transform(F.split(words, rule["pattern"], -1), spaces), 1, F.size(inner))
    both = F.zip_with(between, inner, lambda gap, size: F.struct((gap + size).alias("both"), size.alias("size")))

    def told(found: Column, sums: Column) -> Column:
        def place(end: Column, i: Column) -> Column:
            first = end - F.get(found, i)["size"] - 1
            return F.struct(first.alias("first"), end.alias("end"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence"))

        return F.transform(sums, place)

    return once(both, lambda found: once(_running(F.transform(found, lambda x: x["both"])), lambda sums: told(found, sums)))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def matches(words: Column) -> Column:
    """Places of all rules whose keyword occurs, in order. ``words`` begins and ends with a space."""
    told = F.filter(_rule_array(), lambda r: F.contains(words, r["keyword"]))
    return F.array_sort(F.flatten(F.transform(told, lambda r: _places(words, r))))


def uncovered(found: Column) -> Column:
    """The places that do not lie within one of a higher priority, or of the same and longer, each once. ``found`` is in order.

    What covers a place begins at most ``MOST_WORDS`` words before it, so only those few neighbours are looked at.
    """

    def covers(x: Column, y: Column) -> Column:
        longer = (y["priority"] == x["priority"]) & (y["end"] - y["first"] > x["end"] - x["first"])
        return (y["first"] <= x["first"]) & (y["end"] >= x["end"]) & ((y["priority"] > x["priority"]) | longer)

    halvings = F.transform(F.sequence(F.ceil(F.log2(F.size(found) + 1)).cast("int"), F.lit(0)), lambda s: F.call_function("shiftleft", F.lit(1), s))

    def before(word: Column) -> Column:
        """How many places begin before a word."""
        return F.aggregate(halvings, F.lit(0), lambda n, step: F.when(F.get(found, n + step - 1)["first"] < word, n + step).otherwise(n))

    def free(x: Column, i: Column) -> Column:
        again = (i > 0) & (F.get(found, i - 1) == x)
        low = before(x["first"] - MOST_WORDS)
        return ~again & ~F.exists(F.slice(found, low + 1, before(x["first"] + 1) - low), lambda y: covers(x, y))

    return F.filter(found, free)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_words, n_base, first_word, last_word, base_labels, labels, score, detections``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start (null without one). ``labels`` adds those of the rules' detections that are left; ``score`` is the confidence
    of the surest label (0.6 for a base phrase), 0 without any. A null or empty text has no words. Rows that repeat a key
    are scanned each on their own. Row-local: nothing is shuffled.
    """
    empty = F.from_json(F.lit("[]"), "array<struct<first:int,end:int,priority:int,label:string,confidence:double>>")
    words = F.trim(F.translate(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), GAPS, " "), CAPITALS, SMALL))
    rows = docs.select(F.col(key).alias("id"), F.concat(F.lit(" "), words, F.lit(" ")).alias("words"))
    rows = rows.withColumn("n_words", F.when(F.col("words") == "  ", 0).otherwise(spaces(F.col("words")) - 1).cast("long"))
    for i, phrase in enumerate(BASE):
        parts = F.split("words", _bounded(phrase), -1)
        rows = rows.withColumn(f"parts{i}", F.when(F.contains("words", F.lit(f" {phrase} ")), F.transform(parts, spaces)))
    first = [F.col(f"parts{i}")[0] - 1 for i in range(len(BASE))]
    last = [F.col("n_words") - F.element_at(f"parts{i}", -1) + 1 - len(phrase.split()) for i, phrase in enumerate(BASE)]
    times = [F.coalesce(F.size(F.when(F.col(f"parts{i}").isNotNull(), F.col(f"parts{i}"))) - 1, F.lit(0)) for i in range(len(BASE))]
    met = [F.when(F.col(f"parts{i}").isNotNull(), F.lit(label)) for i, label in enumerate(BASE.values())]
    gate = F.rlike("words", F.lit(" (?:" + "|".join(sorted({sought(r[2])[1:] for r in rules()})) + ")"))
    rows = rows.select(
        "id",
        "n_words",
        reduce(lambda a, b: a + b, [F.greatest(t, F.lit(0)) for t in times]).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*met))).alias("base"),
        F.when(gate, matches(F.col("words"))).otherwise(empty).alias("found"),
    ).withColumn("detections", F.when(F.size("found") > 0, uncovered(F.col("found"))).otherwise(F.col("found")))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform("detections", lambda d: d["label"]))))
    surest = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.6).otherwise(0.0))
    return rows.select(F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), surest.alias("score"), "detections")
