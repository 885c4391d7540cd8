"""Crawl index: JSON lines, wildcard patterns, first-wins URLs, source keys, manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import crawl as C
from pagemill.session import new_table_path, written
from pagemill.sources import json_lines, manifest
from workload import Catalogue, table

catalogue = Catalogue()

# Wildcards over the hosts of the test pages: a repeat, an overlap, several patterns of one host.
PATTERNS = [
    "*.example.net/en/1*",
    "*.tionsh.example.net/*",
    "*.example.net/en/*",
    "*.example.com/fr/*",
    "*.example.net/en/1*",
    "*.example.net/de/*",
    "*.example.com/en/*",
    "*.ththan.example.net/en/*",
    "*.example.org/*",
    "*.nowhere.invalid/*",
    "*.example.com",
]
FILENAME = ("crawl/warc/", 8, ".warc.gz")


def patterns(spark):
    return spark.createDataFrame(list(enumerate(PATTERNS)), "pattern_ord int, pattern string")


def index(spark, sf_dir):
    """Index records made of the pages: eight archives, lines in page order."""
    stem, archives, ending = FILENAME
    filename = F.concat(F.lit(stem), (F.col("page_id") % archives).cast("string"), F.lit(ending))
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("line_ord"), "url", filename.alias("filename"))


def new_urls(spark, sf_dir):
    return C.first_wins(C.match_patterns(index(spark, sf_dir), patterns(spark)))


def sourced(spark, sf_dir):
    return C.sourced_urls(index(spark, sf_dir), patterns(spark))


VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(PATTERNS))
WITH = f"""
    WITH patterns(pattern_ord, pattern) AS (VALUES {VALUES}),
    parsed AS (
        SELECT pattern_ord, split_part(pattern, '/', 1) AS head,
               replace(split_part(pattern, '/', 1), '*.', '') AS host_key,
               replace(split_part(pattern, '/', 1) || split_part(pattern, '/', 2), '*.', '') AS segment_key,
               CASE WHEN contains(pattern, '/')
                    THEN rtrim(substr(pattern, strpos(pattern, '/')), '*') ELSE '/' END AS prefix
        FROM patterns
    ),
    idx AS (
        SELECT page_id AS line_ord, url, 'crawl/warc/' || CAST(page_id % 8 AS VARCHAR) || '.warc.gz' AS filename,
               lower(regexp_extract(url, '://([^/?#:]+)', 1)) AS host,
               regexp_extract(url, '://[^/?#]*(/[^#]*)', 1) AS path
        FROM pages
    ),
    matched AS (
        SELECT pattern_ord, line_ord, url, filename FROM idx JOIN parsed
        ON (host = host_key OR ends_with(host, '.' || host_key))
           AND starts_with(CASE WHEN path = '' THEN '/' ELSE path END, prefix)
    ),
    new_urls AS (
        SELECT * FROM matched
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY pattern_ord, line_ord) = 1
    ),
    source_keys AS (
        SELECT pattern_ord,
               CASE WHEN row_number() OVER (PARTITION BY host_key ORDER BY pattern_ord) = 1
                    THEN host_key ELSE segment_key END AS source
        FROM parsed WHERE pattern_ord IN (SELECT pattern_ord FROM new_urls)
    ),
    sourced AS (SELECT n.*, source FROM new_urls n JOIN source_keys USING (pattern_ord))
"""


@catalogue.query("""
    SELECT event_id, CASE WHEN event_id % 9 <> 4 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
           CASE WHEN event_id % 9 = 4 THEN left(props, length(props) - 1) END AS bad_line
    FROM events
""")
def json_lines_parse(spark, sf_dir):
    """Every ninth line loses its closing brace."""
    line = F.when(F.col("event_id") % 9 == 4, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    parsed = json_lines.parse_json_lines(lines, "line", "k int")
    return parsed.select("event_id", "k", F.col(json_lines.CORRUPT).alias("bad_line"))


@catalogue.query("SELECT count(*) AS n_lines, count(*) FILTER (event_id % 9 = 4) AS n_bad FROM events")
def json_lines_bad_count(spark, sf_dir):
    line = F.when(F.col("event_id") % 9 == 4, F.lit("{")).otherwise(F.col("props"))
    lines = table(spark, sf_dir, "events").select(line.alias("line"))
    return json_lines.count_bad_lines(json_lines.parse_json_lines(lines, "line", "k int"))


@catalogue.query(WITH + "SELECT pattern_ord, line_ord, url, filename FROM matched")
def url_pattern_match(spark, sf_dir):
    return C.match_patterns(index(spark, sf_dir), patterns(spark)).select("pattern_ord", "line_ord", "url", "filename")


@catalogue.query(WITH + "SELECT url, pattern_ord, line_ord, filename FROM new_urls")
def first_wins_urls(spark, sf_dir):
    return new_urls(spark, sf_dir).select("url", "pattern_ord", "line_ord", "filename")


@catalogue.query(WITH + "SELECT pattern_ord, source FROM source_keys")
def source_keys(spark, sf_dir):
    return C.source_keys(written(new_urls(spark, sf_dir), "new-urls"), patterns(spark)).select("pattern_ord", "source")


MANIFEST_ROWS = """
    SELECT source, filename, url,
           row_number() OVER (PARTITION BY source, filename ORDER BY pattern_ord, line_ord) AS url_no
    FROM sourced
"""


@catalogue.query(WITH + MANIFEST_ROWS)
def manifest_rows(spark, sf_dir):
    """Chunks of 16 lines, so that archives really have several."""
    rows = C.manifest_rows(C.manifest_chunks(sourced(spark, sf_dir), chunk_lines=16))
    return rows.select("source", "filename", "url", F.col("url_no").cast("bigint").alias("url_no"))


@catalogue.query(WITH + MANIFEST_ROWS)
def manifest_round_trip(spark, sf_dir):
    """Written, read back and numbered: the order of arrival is kept."""
    path = new_table_path(spark, "manifest")
    manifest.write_manifest(C.manifest_chunks(sourced(spark, sf_dir), chunk_lines=16), path)
    rows = C.manifest_rows(manifest.read_manifest(spark, path))
    return rows.select("source", "filename", "url", F.col("url_no").cast("bigint").alias("url_no"))


@catalogue.query(WITH + MANIFEST_ROWS)
def manifest_array_read(spark, sf_dir):
    """Files that are one JSON array each, one ordered list for each source and archive."""
    path = new_table_path(spark, "manifest-array")
    manifest.write_manifest(C.manifest_chunks(sourced(spark, sf_dir), chunk_lines=16), path, layout="array")
    lists = manifest.read_manifest(spark, path, layout="array")
    rows = lists.select("source", "filename", F.posexplode("urls").alias("pos", "url"))
    return rows.select("source", "filename", "url", (F.col("pos") + 1).cast("bigint").alias("url_no"))


@catalogue.query(WITH + """
    SELECT count(DISTINCT source || ' ' || filename) AS n_entries, count(DISTINCT filename) AS n_archives FROM sourced
""")
def archive_counts(spark, sf_dir):
    return C.archive_counts(sourced(spark, sf_dir))


@catalogue.query(WITH + "SELECT DISTINCT filename FROM sourced ORDER BY filename LIMIT 2")
def first_archives(spark, sf_dir):
    return C.first_archives(sourced(spark, sf_dir), 2)
