import gzip
import re
import tracemalloc
import zlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagemill.functions import web
from pagemill.operators import pages as P
from pagemill.sources.warc import arrow_uri, list_files, pack_files, read_archives, read_file, read_warc


def record(rec_type, url, body, content_type="application/http; msgtype=response", date="2024-08-03T10:00:00Z"):
    head = f"WARC/1.0\r\nWARC-Type: {rec_type}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\n"
    head += f"Content-Type: {content_type}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def http(content_type, body, extra=""):
    header = f"Content-Type: {content_type}\r\n" if content_type else ""
    return f"HTTP/1.1 200 OK\r\n{header}{extra}\r\n".encode() + body


RECORDS = [
    record("warcinfo", "", b"software: x\r\n", "application/warc-fields"),
    record("request", "http://a/1", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request"),
    record("response", "http://a/1", http("text/html", b"<p>one\r\n\r\nWARC/1.0\r\n</p>")),
    record("response", "http://a/2", http("Application/JSON; charset=utf-8", b"{}")),
    record("response", "http://a/3", http(None, b"none")),
    record("response", "http://a/4", http("image/gif", b"GIF")),
    record("response", "http://a/5", http("text/html", b"a\xffb"), date="yesterday"),
    record("response", "http://a/6", http("text/html", b"3\r\nabc\r\n2;x\r\nde\r\n0\r\n\r\n", "Transfer-Encoding: chunked\r\n")),
    record("response", "http://a/7", http("text/html", gzip.compress(b"zipped"), "Content-Encoding: gzip\r\n")),
    record("response", "http://a/8", http("text/html", zlib.compress(b"flat"), "Content-Encoding: deflate\r\n")),
    record("response", "http://a/9", http("text/html", b"not zipped", "Content-Encoding: gzip\r\n")),
]


@pytest.fixture
def folder(tmp_path):
    members = b"".join(gzip.compress(r) for r in RECORDS)
    (tmp_path / "a.warc.gz").write_bytes(members)
    (tmp_path / "b.warc").write_bytes(b"".join(RECORDS))
    (tmp_path / "_SUCCESS").write_bytes(b"")
    return tmp_path


def test_members_and_plain_files_give_the_same_rows(spark, folder):
    rows = read_warc(spark, str(folder))
    assert rows.rdd.getNumPartitions() == 2
    per_file = rows.groupBy("filename").agg(F.sort_array(F.collect_list(F.struct("rec_type", "url", "payload"))).alias("r")).collect()
    assert len(per_file) == 2 and per_file[0]["r"] == per_file[1]["r"] and len(per_file[0]["r"]) == len(RECORDS)


def test_payloads(spark, folder):
    rows = read_warc(spark, f"{folder}/*.gz").filter("rec_type = 'response'").collect()
    payload = {r["url"][-1]: bytes(r["payload"]) for r in rows}
    assert payload["1"] == b"<p>one\r\n\r\nWARC/1.0\r\n</p>"
    assert (payload["6"], payload["7"], payload["8"], payload["9"]) == (b"abcde", b"zipped", b"flat", b"not zipped")


def test_page_rows(spark, folder):
    rows = {r["url"][-1]: r for r in P.page_rows(read_warc(spark, f"{folder}/a.warc.gz")).collect()}
    assert sorted(rows) == ["1", "2", "5", "6", "7", "8", "9"]
    assert rows["2"]["content_type"] == "application/json"
    assert rows["5"]["content"] == "a�b" and rows["5"]["date"] is None
    assert rows["1"]["date"].isoformat() == "2024-08-03T10:00:00"
    strict = P.page_rows(read_warc(spark, f"{folder}/a.warc.gz"), strict=True)
    assert "2" not in {r["url"][-1] for r in strict.collect()}


def test_filters_are_pushed(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = read_warc(spark, f"{folder}/a.warc.gz").filter("rec_type = 'response' AND http_content_type IN ('text/html', 'image/gif')")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter \(", plan)
    assert rows.count() == 7


def test_schema_without_payload(spark, folder):
    rows = read_warc(spark, str(folder), schema="url string, rec_type string")
    assert rows.columns == ["url", "rec_type"] and rows.count() == 2 * len(RECORDS)


def test_truncated_file_keeps_what_came_before(spark, folder):
    whole = (folder / "a.warc.gz").read_bytes()
    (folder / "cut.warc.gz").write_bytes(whole[: len(whole) * 2 // 3])
    (folder / "empty.warc.gz").write_bytes(b"")
    rows = read_warc(spark, str(folder)).withColumn("file", F.regexp_extract("filename", "([^/]+)$", 1))
    counts = {r["file"]: (r["n"], r["bad"]) for r in rows.groupBy("file").agg(F.count("url").alias("n"), F.count("error").alias("bad")).collect()}
    assert counts["a.warc.gz"] == (len(RECORDS), 0) and counts["b.warc"] == (len(RECORDS), 0)
    assert 0 < counts["cut.warc.gz"][0] < len(RECORDS) and counts["cut.warc.gz"][1] == 1
    assert "empty.warc.gz" not in counts
    with pytest.raises(PySparkException):
        read_warc(spark, str(folder), on_error="fail").collect()


@pytest.mark.parametrize("length", [None, "-1", "12a", "", "99999999999999999999", "4000000000"])
def test_damaged_lengths(spark, tmp_path, length):
    damaged = RECORDS[4]
    end = damaged.index(b"\r\nContent-Length"), damaged.index(b"\r\n\r\n")
    line = b"" if length is None else f"\r\nContent-Length: {length}".encode()
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r in [*RECORDS[:4], damaged[: end[0]] + line + damaged[end[1] :], *RECORDS[5:]]))
    rows = read_warc(spark, str(path)).collect()
    assert len(rows) == 5 and [r["error"] is not None for r in rows] == [False] * 4 + [True]
    responses = read_warc(spark, str(path)).filter("rec_type = 'response'")
    assert sorted(str(r["url"]) for r in responses.collect()) == ["None", "http://a/1", "http://a/2"]
    chosen = read_warc(spark, str(path), record_types=["response"])
    assert chosen.count() == 3 and chosen.filter("error is not null").count() == 1
    with pytest.raises(PySparkException):
        read_warc(spark, str(path), on_error="fail").collect()


def test_rejected_payloads_are_not_held(tmp_path):
    """A rejected record of 256 MB passes with a few MB of memory."""
    path = tmp_path / "large.warc"
    size = 256 << 20
    with open(path, "wb") as out:
        out.write(f"WARC/1.0\r\nWARC-Type: request\r\nContent-Type: application/http\r\nContent-Length: {size}\r\n\r\n".encode())
        out.truncate(out.tell() + size)
        out.seek(0, 2)
        out.write(b"\r\n\r\n" + RECORDS[3])
    tracemalloc.start()
    batches = list(read_file(str(path), ["url", "payload"], {"rec_type": {"response"}}, "fail"))
    assert tracemalloc.get_traced_memory()[1] < 16 << 20
    tracemalloc.stop()
    assert [r["url"] for b in batches for r in b.to_pylist()] == ["http://a/2"]


def test_fractional_dates(spark):
    raw = ["2024-08-03T10:00:00Z", "2024-08-03T10:00:00.5Z", "2024-08-03T10:00:00.123456Z", "no", None]
    rows = spark.createDataFrame([(r,) for r in raw], "raw_date string")
    dates = [r[0] for r in rows.select(web.archive_timestamp(F.col("raw_date"))).collect()]
    assert [None if d is None else d.microsecond for d in dates] == [0, 500000, 123456, None, None]
    assert tuple(P.unparsable_dates(rows).first()) == (4, 1)


def test_archives_named_in_a_table(spark, folder):
    files = spark.createDataFrame([(str(folder / "a.warc.gz"),), (str(folder / "missing.warc.gz"),)], "filename string")
    rows = read_archives(files)
    assert rows.filter("error IS NULL").count() == len(RECORDS)
    assert "FileNotFoundError" in rows.filter("error IS NOT NULL").first()["error"]


def test_many_archives_of_a_table_share_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.warc").write_bytes(record("metadata", f"http://a/{i}", b"x", "text/plain"))
    files = spark.range(300).select(F.format_string(f"{tmp_path}/%d.warc", "id").alias("filename"))
    rows = read_archives(files, schema="url string, error string")
    assert rows.rdd.getNumPartitions() == 64 and read_archives(files.limit(3)).rdd.getNumPartitions() <= 3
    assert sorted(r.url for r in rows.collect()) == sorted(f"http://a/{i}" for i in range(300))


def test_wet(spark, tmp_path):
    path = tmp_path / "x.warc.wet.gz"
    path.write_bytes(gzip.compress(record("warcinfo", "", b"x", "application/warc-fields")) + gzip.compress(record("conversion", "http://a", "é".encode(), "text/plain")))
    rows = P.plain_text_rows(read_warc(spark, str(path))).collect()
    assert [(r["url"], r["content"], r["content_type"]) for r in rows] == [("http://a", "é", "text/plain")]


def test_list_files(folder):
    assert [f.rsplit("/", 1)[1] for f, _ in list_files(str(folder))] == ["a.warc.gz", "b.warc"]
    size = (folder / "a.warc.gz").stat().st_size
    assert list_files(f"{folder}/a*.gz") == [(f"{folder}/a.warc.gz", size)]
    assert list_files(f"file://{folder}/*.gz") == [(f"file://{folder}/a.warc.gz", size)]
    assert list_files(f"file:{folder}/*.gz") == [(f"file://{folder}/a.warc.gz", size)]
    with pytest.raises(FileNotFoundError):
        list_files(f"{folder}/nothing")


def test_arrow_uri():
    assert arrow_uri("s3a://b/k") == "s3://b/k"
    assert arrow_uri("file:/a/b") == arrow_uri("file:///a/b") == "file:///a/b"
    assert arrow_uri("/a/b") == "/a/b" and arrow_uri("hdfs://n/a") == "hdfs://n/a"


def test_pack_files():
    large, small = [(f"l{i}", 1 << 30) for i in range(3)], [(f"s{i}", 1000) for i in range(100)]
    assert pack_files(large, 1000) == [["l0"], ["l1"], ["l2"]]
    packs = pack_files(small, 8)
    assert 8 <= len(packs) <= 10 and [u for p in packs for u in p] == [u for u, _ in small]
    assert len(pack_files(small, 1000)) == 100
    assert pack_files([], 4) == []


def test_content_type_labels(spark):
    cases = [
        (None, None, None),
        ("text/html", "text/html", "text/html"),
        ("text/html; charset=utf-8", "text/html", None),
        ("Application/JSON", "application/json", None),
        ("application/pdf", "pdf", "pdf"),
        ("image/gif", None, None),
        ("image/pjpeg", "image/jpeg", "image/jpeg"),
        ("application/xml", "xml", "xml"),
        ("application/xhtml+xml", None, None),
        ("text/csv", "csv", "csv"),
    ]
    rows = spark.createDataFrame([(c[0],) for c in cases], "h string").select(
        web.content_type_label(F.col("h")), web.content_type_label(F.col("h"), strict=True)
    )
    assert [tuple(r) for r in rows.collect()] == [c[1:] for c in cases]
