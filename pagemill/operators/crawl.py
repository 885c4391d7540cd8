"""Crawl-index operators: pattern match, first-wins distinct, source keys, manifests.

``patterns(pattern_ord, pattern)`` are wildcards ``*.domain/prefix*``: the domain itself or any host below it, with
a path that starts with the prefix. ``index(line_ord, url, filename)`` are crawl-index records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pagemill.functions.web import host_suffixes, url_host, url_path
from pagemill.session import broadcast_if_small, written

CHUNK_LINES = 100_000


def parse_patterns(patterns: DataFrame) -> DataFrame:
    """Add ``domain``, ``prefix`` and the two source keys a pattern can get."""
    parts = F.split(F.col("pattern"), "/")
    bare = F.regexp_replace("pattern", r"^\*\.", "")
    slash = F.locate("/", bare)
    path = F.when(slash > 0, F.substr(bare, slash)).otherwise(F.lit("/"))
    return patterns.select(
        "pattern_ord",
        "pattern",
        F.lower(F.split(bare, "/")[0]).alias("domain"),
        F.regexp_replace(path, r"\*$", "").alias("prefix"),
        F.replace(parts[0], F.lit("*."), F.lit("")).alias("host_key"),
        F.replace(F.array_join(F.slice(parts, 1, 2), ""), F.lit("*."), F.lit("")).alias("segment_key"),
    )


def match_patterns(index: DataFrame, patterns: DataFrame, url: str = "url") -> DataFrame:
    """Index rows with each pattern they match.

    Every host suffix of a URL becomes an equi-join key, so no theta join is needed: a pattern table of small
    measured size is broadcast, a large one meets the index by shuffle, where AQE splits a hot domain.
    """
    parsed = broadcast_if_small(parse_patterns(patterns).select("pattern_ord", "domain", "prefix"))
    keyed = index.select(
        "*", url_path(F.col(url)).alias("_path"), F.explode(host_suffixes(url_host(F.col(url)))).alias("domain")
    )
    matched = keyed.join(parsed, "domain").filter(F.col("_path").startswith(F.col("prefix")))
    return matched.select("pattern_ord", *index.columns)


def first_wins(matches: DataFrame) -> DataFrame:
    """One row per URL: the first by pattern, then by line. ``min`` combines before the shuffle."""
    carried = [c for c in matches.columns if c not in ("url", "pattern_ord", "line_ord")]
    first = F.min(F.struct("pattern_ord", "line_ord", *carried)).alias("first")
    return matches.groupBy("url").agg(first).select("url", "first.*")


def source_keys(new_urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """Source key of every pattern that contributed a new URL.

    The first contributing pattern of a host gets the host; later ones get host and first path segment.
    """
    contributing = new_urls.select("pattern_ord").distinct()
    ranked = parse_patterns(patterns).join(contributing, "pattern_ord")
    rank = F.row_number().over(Window.partitionBy("host_key").orderBy("pattern_ord"))
    key = F.when(rank == 1, F.col("host_key")).otherwise(F.col("segment_key"))
    return ranked.select("pattern_ord", "pattern", key.alias("source"))


def assign_sources(new_urls: DataFrame, patterns: DataFrame) -> DataFrame:
    keys = broadcast_if_small(source_keys(new_urls, patterns).select("pattern_ord", "source"))
    return new_urls.join(keys, "pattern_ord")


def sourced_urls(index: DataFrame, patterns: DataFrame) -> DataFrame:
    """Pattern match, first-wins distinct and source keys in one: ``(source, filename, url, pattern_ord, line_ord)``.

    The new URLs are written once, because their keys depend on all of them.
    """
    return assign_sources(written(first_wins(match_patterns(index, patterns)), "new-urls"), patterns)


def manifest_chunks(sourced: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """``(source, filename, chunk_no, urls)`` with at most ``chunk_lines`` URLs each, in arrival order.

    A chunk covers a range of index lines of one pattern, so even an archive that holds most of the rows is
    grouped in pieces; reading chunks by ``chunk_no`` gives the order of arrival.
    """
    chunk = F.struct("pattern_ord", F.floor(F.col("line_ord") / chunk_lines).alias("block")).alias("chunk_no")
    urls = F.array_sort(F.collect_list(F.struct("line_ord", "url")))
    return (
        sourced.groupBy("source", "filename", chunk)
        .agg(urls.alias("lines"))
        .select("source", "filename", "chunk_no", F.col("lines.url").alias("urls"))
    )


def manifest_rows(chunks: DataFrame) -> DataFrame:
    """``(source, filename, url_no, url)``: position of each URL in its archive's list.

    Only chunk sizes are ordered per archive; the URLs get their numbers inside the chunks.
    """
    chunks = written(chunks, "manifest-chunks")
    before = Window.partitionBy("source", "filename").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunks.select("source", "filename", "chunk_no", F.size("urls").alias("n"))
    offsets = sizes.select(
        "source", "filename", "chunk_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    placed = chunks.join(offsets, ["source", "filename", "chunk_no"])
    return placed.select("source", "filename", "start", F.posexplode("urls").alias("pos", "url")).select(
        "source", "filename", (F.col("start") + F.col("pos") + 1).alias("url_no"), "url"
    )


def archive_counts(sourced: DataFrame) -> DataFrame:
    """Number of (source, archive) entries and of distinct archives."""
    pairs = sourced.select("source", "filename").distinct()
    return pairs.agg(
        F.count("*").alias("n_entries"), F.countDistinct("filename").alias("n_archives")
    )


def archive_list(sourced: DataFrame) -> DataFrame:
    return sourced.select("filename").distinct()


def first_archives(sourced: DataFrame, n: int) -> DataFrame:
    """The first ``n`` distinct archives by name."""
    return archive_list(sourced).orderBy("filename").limit(n)
