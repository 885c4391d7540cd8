"""Manifest files: which archive file holds which URLs of a source.

In the engine a manifest is the flat table ``(source, filename, chunk_no, urls)``; ``operators.crawl`` builds it
with bounded chunks, so no (source, archive) pair has to fit in one task. On disk it is JSON:

``lines``  one object ``{"chunk_no": ..., "manifest": {source: {filename: [url, ...]}}}`` per line and chunk; splittable, and
           chunks keep their order;
``array``  one JSON array of objects ``{source: {filename: [url, ...]}}`` per file, the form of a dump made elsewhere: one file is
           one document, with one ordered list for each source and archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = "struct<pattern_ord:int,block:bigint>"
SNAPSHOT = "map<string,map<string,array<string>>>"


def write_manifest(chunks: DataFrame, path: str, layout: str = "lines") -> None:
    """Write ``(source, filename, chunk_no, urls)``.

    ``array`` writes one file per source, and so gathers a source's URLs in one task; it is meant for manifests that other
    tools read whole.
    """
    nested = F.create_map(F.col("source"), F.create_map(F.col("filename"), F.col("urls")))
    if layout == "lines":
        lines = chunks.select(F.to_json(F.struct("chunk_no", nested.alias("manifest"))).alias("value"))
    elif layout == "array":
        ordered = F.array_sort(F.collect_list(F.struct("chunk_no", "urls")))
        lists = chunks.groupBy("source", "filename").agg(F.flatten(ordered["urls"]).alias("urls"))
        files = F.map_from_entries(F.array_sort(F.collect_list(F.struct("filename", "urls"))))
        whole = lists.groupBy("source").agg(files.alias("files")).select(F.to_json(F.array(F.create_map("source", "files"))).alias("value"), "source")
        lines = whole.repartition("source").select("value", F.sha1("source").alias("of"))
    else:
        raise ValueError(f"unknown manifest layout: {layout}")
    writer = lines.write.mode("overwrite").option("compression", "gzip")
    (writer.partitionBy("of") if layout == "array" else writer).text(path)


def read_manifest(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Flat ``(source, filename, chunk_no, urls)`` rows of manifest files; ``chunk_no`` is NULL where a file has none."""
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown manifest layout: {layout}")
    return flatten_manifest(spark.read.text(path, wholetext=layout == "array").select("value"), "value", layout)


def flatten_manifest(documents: DataFrame, column: str, layout: str = "lines") -> DataFrame:
    """Manifest JSON held in a column, one object (``lines``) or one array of objects (``array``) per row."""
    none = F.lit(None).cast(CHUNK)
    if layout == "array":
        snapshots = documents.select(none.alias("chunk_no"), F.explode(F.from_json(column, f"array<{SNAPSHOT}>")).alias("snapshot"))
    else:
        line = F.from_json(column, f"chunk_no {CHUNK}, manifest {SNAPSHOT}")
        bare = F.when(line["manifest"].isNull(), F.from_json(column, SNAPSHOT))
        snapshots = documents.select(line["chunk_no"].alias("chunk_no"), F.coalesce(line["manifest"], bare).alias("snapshot"))
    sources = snapshots.select("chunk_no", F.explode("snapshot").alias("source", "files"))
    return sources.select("source", F.explode("files").alias("filename", "urls"), "chunk_no").select("source", "filename", "chunk_no", "urls")


def manifest_urls(manifest: DataFrame) -> DataFrame:
    """One row per URL."""
    return manifest.select("source", "filename", F.explode("urls").alias("url"))
