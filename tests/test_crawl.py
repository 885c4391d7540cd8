import json

import pytest
from pyspark.sql import functions as F

from pagemill.operators import crawl as C
from pagemill.session import new_table_path
from pagemill.sources import json_lines, manifest


def frames(spark, patterns, lines):
    return (
        spark.createDataFrame(list(enumerate(patterns)), "pattern_ord int, pattern string"),
        spark.createDataFrame(lines, "line_ord long, url string, filename string"),
    )


LINES = [
    (1, "http://a.com/news/1", "f0"),
    (2, "http://x.a.com/news/1", "f1"),
    (3, "http://a.com/docs/10", "f0"),
    (4, "http://a.com/news/1", "f1"),
    (5, "http://b.org/new/3", "f2"),
    (6, "http://xb.org/news/3", "f2"),
    (7, "http://a.com/docs/2", "f0"),
    (8, "http://y.x.a.com/z", "f0"),
    (9, "http://a.com/new/7", "f0"),
    (10, "http://a.com/news/2", "f0"),
    (11, "http://c.net/", "f0"),
]


@pytest.mark.parametrize(
    "patterns, manifest_of",
    [
        (["*.b.org/*"], {"b.org": {"f2": ["http://b.org/new/3"]}}),
        (["*.none.com/*", "*.c.net/x*"], {}),
        (
            ["*.a.com/news/*", "*.x.a.com/*"],
            {"a.com": {"f0": ["http://a.com/news/1", "http://a.com/news/2"], "f1": ["http://x.a.com/news/1"]}, "x.a.com": {"f0": ["http://y.x.a.com/z"]}},
        ),
        (
            ["*.a.com/none/*", "*.a.com/news/*", "*.a.com/docs/1*", "*.a.com/new*", "*.a.com/docs/*"],
            {
                "a.com": {"f0": ["http://a.com/news/1", "http://a.com/news/2"], "f1": ["http://x.a.com/news/1"]},
                "a.comdocs": {"f0": ["http://a.com/docs/10", "http://a.com/docs/2"]},
                "a.comnew*": {"f0": ["http://a.com/new/7"]},
            },
        ),
    ],
)
@pytest.mark.parametrize("chunk_lines", [1, 3, 100])
def test_manifest_of_a_few_lines(spark, patterns, manifest_of, chunk_lines):
    table, index = frames(spark, patterns, LINES)
    sourced = C.assign_sources(C.first_wins(C.match_patterns(index, table)), table)
    rows = C.manifest_rows(C.manifest_chunks(sourced, chunk_lines)).orderBy("source", "filename", "url_no").collect()
    built = {}
    for row in rows:
        built.setdefault(row["source"], {}).setdefault(row["filename"], []).append(row["url"])
    assert built == manifest_of
    counts = C.archive_counts(sourced).first()
    assert counts["n_entries"] == sum(len(files) for files in manifest_of.values())
    assert [r[0] for r in C.first_archives(sourced, 2).collect()] == sorted({f for files in manifest_of.values() for f in files})[:2]


def test_chunks_are_bounded(spark):
    _, index = frames(spark, ["*"], [(i, f"http://a/{i}", "f") for i in range(95)])
    sourced = index.select("*", F.lit(0).alias("pattern_ord"), F.lit("s").alias("source"))
    sizes = [r["n"] for r in C.manifest_chunks(sourced, 10).select(F.size("urls").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) == 10


def test_match_is_an_equi_join(spark):
    table, index = frames(spark, ["*.a.com/*"], [(1, "http://a.com", "f"), (2, "http://evil-a.com/", "f"), (3, "ftp://u@S.A.com:21?x", "f")])
    matched = C.match_patterns(index, table)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(r["line_ord"] for r in matched.collect()) == [1, 3]


def test_manifest_files(spark, tmp_path):
    chunk = "struct<pattern_ord:int,block:bigint>"
    rows = [("s", "f", (0, 1), ["u3"]), ("s", "f", (0, 0), ["u1", "u2"]), ("s", "f", (2, 0), ["u4"]), ("s", "g", (0, 0), ["u5"]), ("t", "f", (1, 0), ["u6"])]
    chunks = spark.createDataFrame(rows, f"source string, filename string, chunk_no {chunk}, urls array<string>")
    path = new_table_path(spark, "manifest-test")
    manifest.write_manifest(chunks, path)
    assert sorted(tuple(r) for r in manifest.read_manifest(spark, path).collect()) == sorted(rows)
    lists = [("s", "f", ["u1", "u2", "u3", "u4"]), ("s", "g", ["u5"]), ("t", "f", ["u6"])]
    manifest.write_manifest(chunks, path + "-array", layout="array")
    assert sorted((r["source"], r["filename"], r["urls"]) for r in manifest.read_manifest(spark, path + "-array", layout="array").collect()) == lists

    snapshots = [{"s": {"f": ["u1"]}}, {"s": {"f": ["u1"], "g": ["u2"]}, "t": {"f": ["u3"]}}]
    (tmp_path / "links.json").write_text(json.dumps(snapshots, indent=4))
    found = manifest.read_manifest(spark, str(tmp_path / "links.json"), layout="array").collect()
    assert sorted((r["source"], r["filename"], r["urls"]) for r in found) == [("s", "f", ["u1"]), ("s", "f", ["u1"]), ("s", "g", ["u2"]), ("t", "f", ["u3"])]
    (tmp_path / "old.json").write_text('{"s": {"f": ["u1", "u2"]}}\n{"s": {"g": ["u3"]}}\n')
    found = manifest.read_manifest(spark, str(tmp_path / "old.json")).collect()
    assert sorted((r["filename"], r["urls"], r["chunk_no"]) for r in found) == [("f", ["u1", "u2"], None), ("g", ["u3"], None)]


def test_json_lines(spark, tmp_path):
    lines = ['{"url": "a", "filename": "f", "extra": 1}', "{bad", "", "[1]", "12", '{"url": null}', '{"url": "b"']
    (tmp_path / "index.json").write_text("\n".join(lines))
    parsed = json_lines.read_json_lines(spark, str(tmp_path / "index.json"), "url string, filename string")
    assert [tuple(r) for r in json_lines.good_lines(parsed).collect()] == [("a", "f"), (None, None)]
    assert [r["_corrupt"] for r in json_lines.bad_lines(parsed).collect()] == ["{bad", "", "[1]", "12", '{"url": "b"']
    assert tuple(json_lines.count_bad_lines(parsed).first()) == (7, 5)
