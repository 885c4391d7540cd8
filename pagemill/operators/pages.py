"""Page-row operators: record filters, typed page rows, HTML fields, media and language filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html, web
from pagemill.functions.text import guess_language

# Title texts that servers put on error pages they deliver as found.
NOT_FOUND_TITLES = ["404 not found", "page not found", "error 404", "not found"]


def response_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("rec_type") == "response")


def conversion_records(records: DataFrame) -> DataFrame:
    """Records of a plain-text archive."""
    return records.filter(F.col("rec_type") == "conversion")


def with_content_type(records: DataFrame, header: str = "http_content_type", strict: bool = False) -> DataFrame:
    """Label the content type; records without a header or outside the rules go."""
    labelled = records.filter(F.col(header).isNotNull()).withColumn(
        "content_type", web.content_type_label(F.col(header), strict)
    )
    return labelled.filter(F.col("content_type").isNotNull())


def page_rows(records: DataFrame, strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Archive rows to ``(url, date, content, content_type)``.

    With ``keep``, these columns follow and rows with ``error`` stay, without content.
    """
    if keep is None:
        kept = with_content_type(response_records(records), strict=strict)
    else:
        label = web.content_type_label(F.col("http_content_type"), strict)
        kept = records.filter((F.col("rec_type") == "response") | F.col("error").isNotNull())
        kept = kept.withColumn("content_type", label).filter(F.col("content_type").isNotNull() | F.col("error").isNotNull())
    return kept.select(
        "url",
        web.archive_timestamp(F.col("raw_date")).alias("date"),
        web.decode_utf8(F.col("payload")).alias("content"),
        "content_type",
        *(keep or ()),
    )


def unparsable_dates(records: DataFrame) -> DataFrame:
    """One row: ``n_dates`` given and ``n_unparsable`` of them, which become NULL."""
    raw = F.col("raw_date")
    bad = raw.isNotNull() & web.archive_timestamp(raw).isNull()
    return records.agg(F.count(raw).alias("n_dates"), F.count_if(bad).alias("n_unparsable"))


def plain_text_rows(records: DataFrame) -> DataFrame:
    """Rows of a plain-text archive, same shape as ``page_rows``."""
    return conversion_records(records).select(
        "url",
        web.archive_timestamp(F.col("raw_date")).alias("date"),
        web.decode_utf8(F.col("payload")).alias("content"),
        F.lit("text/plain").alias("content_type"),
    )


def with_html_fields(pages: DataFrame, content: str = "content", limit: int | None = 10) -> DataFrame:
    """Add ``title``, ``title_content`` and ``body_content``; the page is cleaned once for all three."""
    clean = F.col("_clean")
    return (
        pages.withColumn("_clean", html.clean_html(F.col(content)))
        .withColumn("title", html.html_title(clean))
        .withColumn("title_content", html.html_headings(clean, limit))
        .withColumn("body_content", html.html_paragraphs(clean, limit))
        .drop("_clean")
    )


def paragraph_chunks(pages: DataFrame, key: str, content: str = "content") -> DataFrame:
    """One row per paragraph of the whole page: ``(key, chunk_no, text)``."""
    clean = pages.select(key, html.clean_html(F.col(content)).alias("_clean"))
    return clean.select(key, F.posexplode(html.html_paragraphs(F.col("_clean"), None)).alias("chunk_no", "text"))


def url_contains(pages: DataFrame, needle: str, regex: bool = False, url: str = "url") -> DataFrame:
    column = F.col(url)
    return pages.filter(column.rlike(needle) if regex else column.contains(needle))


def media_pages(pages: DataFrame) -> DataFrame:
    """PDFs and images; on a table partitioned by ``content_type`` only those folders are read."""
    return pages.filter((F.col("content_type") == "pdf") | F.col("content_type").startswith("image/"))


def in_language(documents: DataFrame, lang: str, column: str = "lang") -> DataFrame:
    return documents.filter(F.col(column) == lang)


def with_guessed_language(documents: DataFrame, text: str = "text", output: str = "lang_guess") -> DataFrame:
    """Stop-word vote for tables without a language column."""
    return documents.withColumn(output, guess_language(F.col(text)))


def not_found_score(title: Column, templates: list[str] | None = None) -> Column:
    """Similarity 0..1 of a title to the nearest error-page title."""
    text = F.lower(F.trim(title))
    scores = [
        1 - F.levenshtein(text, F.lit(t)) / F.greatest(F.length(text), F.lit(len(t)))
        for t in (templates or NOT_FOUND_TITLES)
    ]
    return F.greatest(*scores)
