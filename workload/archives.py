"""Web archives written from the pages, read back through the ``warc`` source; header, date and type columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import web
from pagemill.operators import pages as P
from pagemill.operators.tables import row_by_key
from pagemill.plans.publish import broken_archives, publish_corpus
from pagemill.session import new_table_path
from pagemill.sources.corpus import read_corpus, write_corpus
from pagemill.sources.warc import SCHEMA, read_archives, read_warc
from workload import Catalogue, table
from workload.html import CLEANED, HEADINGS, PARAGRAPHS, TITLE

catalogue = Catalogue()

HEADERS = [
    "text/html",
    "text/html; charset=utf-8",
    "Application/JSON",
    "application/ld+json",
    "application/pdf",
    None,
    "application/xml",
    "text/csv",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "image/jpeg",
    "image/png",
    "image/gif",
    "text/plain",
    "TEXT/HTML",
]
RECORD_TYPES = ["response", "response", "response", "request", "metadata"]
PAGES_PER_FILE = 32

SQL_HEADER = "[" + ", ".join("NULL" if h is None else f"'{h}'" for h in HEADERS) + f"][page_id % {len(HEADERS)} + 1]"
SQL_TYPE = "[" + ", ".join(f"'{t}'" for t in RECORD_TYPES) + f"][page_id % {len(RECORD_TYPES)} + 1]"
SQL_DATE = "TIMESTAMP '2024-08-03 10:00:00' + to_seconds(CAST(page_id * 61 AS DOUBLE))"
SQL_LENIENT = "lower(trim(split_part(h, ';', 1)))"


def sql_label(value: str) -> str:
    return f"""CASE WHEN {value} = 'text/html' THEN 'text/html'
        WHEN contains({value}, 'json') THEN 'application/json' WHEN contains({value}, 'pdf') THEN 'pdf'
        WHEN {value} = 'application/xml' THEN 'xml' WHEN {value} = 'text/csv' THEN 'csv'
        WHEN {value} = '{HEADERS[8]}' THEN 'xlsx'
        WHEN contains({value}, 'image') AND contains({value}, 'jpeg') THEN 'image/jpeg'
        WHEN contains({value}, 'image') AND contains({value}, 'png') THEN 'image/png' END"""


RECORDS = f"SELECT page_id, url, html, {SQL_HEADER} AS h, {SQL_TYPE} AS rec_type, {SQL_DATE} AS ts FROM pages"
LABELLED = f"SELECT *, {sql_label(SQL_LENIENT)} AS content_type FROM ({RECORDS})"


def _pick(values: list, key: str = "page_id") -> Column:
    constants = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(constants, (F.col(key) % len(values) + 1).cast("int"))


def records(spark, sf_dir) -> DataFrame:
    """The pages as archive records, before any file is written."""
    seconds = F.expr("unix_seconds(TIMESTAMP '2024-08-03 10:00:00 UTC')") + F.col("page_id") * 61
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        "html",
        _pick(HEADERS).alias("http_content_type"),
        _pick(RECORD_TYPES).alias("rec_type"),
        F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("raw_date"),
    )


def _record_text(content_type: str, body: Column) -> Column:
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), "rec_type", F.lit("\r\nWARC-Target-URI: "), "url",
        F.lit("\r\nWARC-Date: "), "raw_date", F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
    )


def write_archives(rows: DataFrame, text: Column, path: str) -> str:
    """Gzipped archive files of ``PAGES_PER_FILE`` pages in page order, below ``path``."""
    files = rows.select("page_id", F.floor(F.col("page_id") / PAGES_PER_FILE).alias("file"), text.alias("value"))
    ordered = files.repartition("file").sortWithinPartitions("file", "page_id").drop("page_id")
    ordered.write.partitionBy("file").option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)
    return path


def warc_files(spark, sf_dir, broken_every: int | None = None) -> str:
    """Response records with an HTTP header block; ``broken_every`` puts a line of garbage before some records."""
    header = F.coalesce(F.concat(F.lit("Content-Type: "), "http_content_type", F.lit("\r\n")), F.lit(""))
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nServer: test\r\n"), header, F.lit("\r\n"), "html")
    text = _record_text("application/http; msgtype=response", body)
    if broken_every:
        text = F.when(F.col("page_id") % broken_every == broken_every - 1, F.concat(F.lit("no record\r\n"), text)).otherwise(text)
    return write_archives(records(spark, sf_dir), text, new_table_path(spark, "warc"))


def wet_files(spark, sf_dir) -> str:
    rows = records(spark, sf_dir).withColumn("rec_type", F.lit("conversion"))
    return write_archives(rows, _record_text("text/plain", F.col("html")), new_table_path(spark, "wet"))


@catalogue.query(f"""
    SELECT url, rec_type, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS raw_date, h AS http_content_type,
           md5(html) AS payload_md5, CAST(NULL AS VARCHAR) AS error
    FROM ({RECORDS})
""")
def warc_scan(spark, sf_dir):
    rows = read_warc(spark, warc_files(spark, sf_dir))
    return rows.select("url", "rec_type", "raw_date", "http_content_type", F.md5("payload").alias("payload_md5"), "error")


@catalogue.query(f"SELECT url, md5(html) AS payload_md5 FROM ({RECORDS}) WHERE rec_type = 'response'")
def warc_scan_pushdown(spark, sf_dir):
    """The record type is filtered inside the reader."""
    rows = read_warc(spark, warc_files(spark, sf_dir)).filter(F.col("rec_type") == "response")
    return rows.select("url", F.md5("payload").alias("payload_md5"))


@catalogue.query(f"SELECT url, rec_type, md5(html) AS payload_md5 FROM ({RECORDS})")
def warc_scan_from_manifest(spark, sf_dir):
    """Archive names come from a table, not from a listing."""
    files = spark.read.format("binaryFile").load(f"{warc_files(spark, sf_dir)}/*").select("path")
    rows = read_archives(files, "path", SCHEMA)
    return rows.select("url", "rec_type", F.md5("payload").alias("payload_md5"))


@catalogue.query(f"""
    WITH placed AS (SELECT *, page_id // {PAGES_PER_FILE} AS f FROM ({RECORDS})),
    stops AS (SELECT f, min(page_id) AS stop FROM placed WHERE page_id % 50 = 49 GROUP BY f)
    SELECT url, md5(html) AS payload_md5, false AS is_error FROM placed LEFT JOIN stops USING (f)
    WHERE stop IS NULL OR page_id < stop
    UNION ALL SELECT NULL, NULL, true FROM stops
""")
def warc_broken_files(spark, sf_dir):
    """A broken file keeps the records before the break and adds one error row; the other files are whole."""
    rows = read_warc(spark, warc_files(spark, sf_dir, broken_every=50))
    return rows.select("url", F.md5("payload").alias("payload_md5"), F.col("error").isNotNull().alias("is_error"))


@catalogue.query(f"SELECT url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, html AS content FROM ({RECORDS})")
def wet_scan(spark, sf_dir):
    rows = P.plain_text_rows(read_warc(spark, wet_files(spark, sf_dir)))
    return rows.select("url", web.date_text(F.col("date")).alias("date"), "content")


@catalogue.query("""
    SELECT page_id, 'crawl/segments/wet/' || CAST(page_id AS VARCHAR) || '.warc.wet.gz' AS wet FROM pages
""")
def wet_path(spark, sf_dir):
    key = F.concat(F.lit("crawl/segments/warc/"), F.col("page_id").cast("string"), F.lit(".warc.gz"))
    return table(spark, sf_dir, "pages").select("page_id", web.wet_path(key).alias("wet"))


@catalogue.query(f"""
    SELECT url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, html AS content, content_type FROM ({LABELLED})
    WHERE rec_type = 'response' AND content_type IS NOT NULL
""")
def warc_page_rows(spark, sf_dir):
    """Scan, record filter, header and date columns, decoding and classification in one job."""
    rows = P.page_rows(read_warc(spark, warc_files(spark, sf_dir)))
    return rows.withColumn("date", web.date_text(F.col("date")))


@catalogue.query(f"SELECT page_id, url FROM ({RECORDS}) WHERE rec_type = 'response'")
def record_type_filter(spark, sf_dir):
    return P.response_records(records(spark, sf_dir)).select("page_id", "url")


@catalogue.query(f"SELECT page_id, h AS header FROM ({RECORDS}) WHERE h IS NOT NULL AND ({sql_label(SQL_LENIENT)}) IS NOT NULL")
def content_type_filter(spark, sf_dir):
    kept = P.with_content_type(records(spark, sf_dir))
    return kept.select("page_id", F.col("http_content_type").alias("header"))


@catalogue.query(f"SELECT page_id, {sql_label(SQL_LENIENT)} AS label, {sql_label('h')} AS strict_label FROM ({RECORDS})")
def content_type_classify(spark, sf_dir):
    header = F.col("http_content_type")
    return records(spark, sf_dir).select(
        "page_id",
        web.content_type_label(header).alias("label"),
        web.content_type_label(header, strict=True).alias("strict_label"),
    )


@catalogue.query("""
    SELECT event_id, CASE WHEN event_id % 11 <> 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date FROM events
""")
def archive_date(spark, sf_dir):
    """Every eleventh date does not parse."""
    raw = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = F.when(F.col("event_id") % 11 == 5, F.lit("2024-13-45T99:00:00Z")).otherwise(raw)
    return table(spark, sf_dir, "events").select(
        "event_id", web.date_text(web.archive_timestamp(raw)).alias("date")
    )


@catalogue.query("""
    SELECT page_id, url || chr(65533) || 'é' || chr(65533) AS replaced, url || 'é' AS ignored FROM pages
""")
def decode_utf8(spark, sf_dir):
    """Every URL gets a stray byte, a good two-byte character and a cut one."""
    payload = F.concat(F.col("url").cast("binary"), F.unhex(F.lit("FFC3A9C3")))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        web.decode_utf8(payload).alias("replaced"),
        web.decode_utf8(payload, errors="ignore").alias("ignored"),
    )


@catalogue.query("SELECT page_id, url FROM pages WHERE contains(url, 'tion')")
def url_substring(spark, sf_dir):
    return P.url_contains(table(spark, sf_dir, "pages"), "tion").select("page_id", "url")


@catalogue.query("SELECT page_id, url FROM pages WHERE regexp_matches(url, 'utm_|page=[0-9]+')")
def url_regex(spark, sf_dir):
    return P.url_contains(table(spark, sf_dir, "pages"), "utm_|page=[0-9]+", regex=True).select("page_id", "url")


@catalogue.query("SELECT page_id, url, html FROM pages WHERE page_id = 22")
def keyed_row(spark, sf_dir):
    return row_by_key(table(spark, sf_dir, "pages"), "page_id", 22)


def _typed_pages(spark, sf_dir):
    return P.with_content_type(records(spark, sf_dir)).select("page_id", "url", "html", "content_type")


@catalogue.query(f"SELECT page_id, url, html, content_type FROM ({LABELLED}) WHERE content_type IS NOT NULL")
def parquet_round_trip(spark, sf_dir):
    path = new_table_path(spark, "pages")
    write_corpus(_typed_pages(spark, sf_dir), path)
    return read_corpus(spark, path)


@catalogue.query(f"""
    SELECT page_id, content_type FROM ({LABELLED}) WHERE content_type = 'pdf' OR starts_with(content_type, 'image/')
""")
def media_filter(spark, sf_dir):
    """Only the folders of media types are read."""
    path = new_table_path(spark, "pages")
    write_corpus(_typed_pages(spark, sf_dir), path)
    return P.media_pages(read_corpus(spark, path)).select("page_id", "content_type")


@catalogue.query(f"""
    WITH kept AS (SELECT * FROM ({LABELLED}) WHERE rec_type = 'response' AND content_type IS NOT NULL),
    cleaned AS (SELECT k.*, cl.c FROM kept k JOIN ({CLEANED}) cl USING (page_id))
    SELECT url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, md5(html) AS content_md5, content_type,
           {TITLE} AS title, array_to_string({HEADINGS}[1:10], '|') AS title_content,
           array_to_string({PARAGRAPHS}[1:10], '|') AS body_content
    FROM cleaned
""")
def publish_fields(spark, sf_dir):
    """The whole job; the columns that have an SQL form."""
    archives = read_warc(spark, warc_files(spark, sf_dir), record_types=["response"])
    corpus, _ = publish_corpus(archives, new_table_path(spark, "publish"))
    return corpus.select(
        "url",
        web.date_text(F.col("date")).alias("date"),
        F.md5("content").alias("content_md5"),
        "content_type",
        "title",
        F.array_join("title_content", "|").alias("title_content"),
        F.array_join("body_content", "|").alias("body_content"),
    )


@catalogue.query(columns="url string, date timestamp, content string, title string, title_content array<string>, body_content array<string>, content_embedded array<double>, content_idf array<double>, content_type string", holds=lambda r: r.url and len(r.title_content) <= 10 and len(r.body_content) <= 10)
def publish_corpus_table(spark, sf_dir):
    """The whole job, all published columns."""
    target = new_table_path(spark, "publish")
    return publish_corpus(read_warc(spark, warc_files(spark, sf_dir), record_types=["response"]), target)[0]


@catalogue.query(f"""
    SELECT 'file=' || CAST(page_id // {PAGES_PER_FILE} AS VARCHAR) AS archive, count(*) > 0 AS is_reported
    FROM ({RECORDS}) WHERE page_id % 50 = 49 GROUP BY 1
""")
def publish_broken_archives(spark, sf_dir):
    """The archives that the whole job could not read to their end."""
    target = new_table_path(spark, "publish")
    publish_corpus(read_warc(spark, warc_files(spark, sf_dir, broken_every=50), record_types=["response"]), target)
    broken = broken_archives(spark, target)
    return broken.select(F.regexp_extract("filename", "(file=[0-9]+)", 1).alias("archive"), F.col("error").isNotNull().alias("is_reported"))


@catalogue.query("""
    SELECT count(*) AS n_dates, count(*) FILTER (event_id % 11 = 5) AS n_unparsable FROM events
""")
def archive_date_errors(spark, sf_dir):
    """Every eleventh date does not parse; every third has a fraction of a second."""
    raw = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(raw)
    raw = F.when(F.col("event_id") % 11 == 5, F.lit("2024-13-45T99:00:00Z")).otherwise(raw)
    return P.unparsable_dates(table(spark, sf_dir, "events").select(raw.alias("raw_date")))
