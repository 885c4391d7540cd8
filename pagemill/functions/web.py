"""URL, header and content-type expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[^/?#]*//[^/?#]*(/[^#]*)"
WARC_DATE = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]X"
DATE_TEXT = "yyyy-MM-dd HH:mm:ss"

# Content-type rules in order (test, needle, label); the first match wins.
CONTENT_TYPES = [
    ("equals", "text/html", "text/html"),
    ("contains", "json", "application/json"),
    ("contains", "pdf", "pdf"),
    ("equals", "application/xml", "xml"),
    ("equals", "text/csv", "csv"),
    ("equals", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "xlsx"),
    ("image", "jpeg", "image/jpeg"),
    ("image", "png", "image/png"),
]


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def url_path(url: Column) -> Column:
    """Path and query, at least ``/``."""
    path = F.regexp_extract(url, PATH, 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` to ``[a.b.c, b.c, c]``: the keys a domain can be matched on with an equi-join."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def wet_path(filename: Column) -> Column:
    """Archive key of the plain-text twin of an archive file."""
    return F.replace(F.replace(filename, F.lit("/warc/"), F.lit("/wet/")), F.lit("warc.gz"), F.lit("warc.wet.gz"))


def content_type_label(header: Column, strict: bool = False) -> Column:
    """Label of an HTTP ``Content-Type``; NULL for types outside the rules.

    ``strict`` compares the header as it came, so parameters and capitals keep a type from matching.
    """
    value = header if strict else F.lower(F.trim(F.split(header, ";")[0]))
    tests = {
        "equals": lambda needle: value == needle,
        "contains": lambda needle: value.contains(needle),
        "image": lambda needle: value.contains("image") & value.contains(needle),
    }
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for test, needle, name in CONTENT_TYPES:
        label = label.when(tests[test](needle), F.lit(name))
    return label


def archive_timestamp(raw: Column) -> Column:
    """ISO-8601 ``Z`` text, with a fraction of a second or without, to TIMESTAMP; NULL when it does not parse."""
    return F.try_to_timestamp(raw, F.lit(WARC_DATE))


def date_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, DATE_TEXT)


def decode_utf8(payload: Column, errors: str = "replace") -> Column:
    """Bytes (or text) to text; bad sequences become U+FFFD, or vanish with ``errors='ignore'``.

    ``ignore`` also removes a U+FFFD that was really in the text.
    """
    text = F.make_valid_utf8(payload.cast("string"))
    return text if errors == "replace" else F.replace(text, F.lit("�"), F.lit(""))
