"""HTML fields as column expressions.

The patterns avoid look-around and back-references, so the same text runs in Java and in RE2 engines.
Comments, scripts and styles go first; ``clean_html`` is meant to be a column of its own so that title,
headings and paragraphs share one pass.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# One ``<`` for all three: a place without it fails at once.
CLEAN = r"(?is)<(?:!--.*?-->|script(?:\s[^>]*)?>.*?</script\s*>|style(?:\s[^>]*)?>.*?</style\s*>)"
TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
HEADING = r"(?is)<h[1-6](?:\s[^>]*)?>(.*?)</h[1-6]\s*>"
# A new <p> closes an open one, so the text is cut at every opening tag ...
PARAGRAPH_OPEN = r"(?i)<p(?:[\s/][^>]*)?>"
# ... and each piece ends at </p>, at the end of an enclosing block or where a block element starts.
PARAGRAPH_END = (
    r"(?is)<(?:/(?:p|div|article|section|main|aside|header|footer|nav|body|html|table|tr|td|th|li|ul|ol|dl|form"
    r"|blockquote|fieldset)|div|h[1-6]|ul|ol|dl|dt|dd|li|table|form|hr|pre|blockquote|address|center|fieldset)"
    r"(?:[\s/][^>]*)?>.*"
)
TAG = r"<[^>]*>"
# The references that make up nearly all of them are replaced directly, ``&amp;`` last.
COMMON = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}
OTHER_ENTITY = r"&(?!(?:lt|gt|quot|#39|nbsp|amp);)"  # any other use of ``&``
# Numbers may have any length and lack the semicolon, as browsers read them; names need it.
ENTITY = r"^(?:(#[0-9]+|#[xX][0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]*);)"


def clean_html(html: Column) -> Column:
    return F.regexp_replace(html, CLEAN, "")


def html_title(clean: Column) -> Column:
    """Text of the first ``<title>``; ``''`` without one."""
    return F.coalesce(decode_entities(F.regexp_extract(clean, TITLE, 1)), F.lit(""))


def html_headings(clean: Column, limit: int | None = 10) -> Column:
    """Texts of the first ``limit`` headings ``h1``..``h6`` in document order."""
    return _texts(F.regexp_extract_all(clean, F.lit(HEADING), F.lit(1)), 1, limit)


def html_paragraphs(clean: Column, limit: int | None = 10) -> Column:
    """Texts of the first ``limit`` paragraphs; ``None`` keeps them all."""
    cut = F.transform(_window(F.split(clean, PARAGRAPH_OPEN), 2, limit), lambda p: F.regexp_replace(p, PARAGRAPH_END, ""))
    return _texts(cut, 1, None)


def _window(items: Column, start: int, limit: int | None) -> Column:
    if limit is None and start == 1:
        return items
    return F.slice(items, start, F.size(items) if limit is None else limit)


def _texts(fragments: Column, start: int, limit: int | None) -> Column:
    plain = F.transform(
        _window(fragments, start, limit), lambda f: decode_entities(F.regexp_replace(f, TAG, ""))
    )
    return F.coalesce(plain, F.array().cast("array<string>"))


def _named_entities() -> Column:
    """The HTML 4 names of the Python standard library, plus ``apos``, as one constant map."""
    characters = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}
    lines = "\n".join(f"{name}\t{character}" for name, character in characters.items())
    return F.str_to_map(F.lit(lines), F.lit("\n"), F.lit("\t"))


def _code_point(digits: Column, base: int) -> Column:
    significant = F.ltrim(digits, F.lit("0"))
    number = F.when(F.length(significant) <= 8, F.conv(significant, base, 10).cast("bigint"))  # longer ones are no characters
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(valid, character).otherwise(F.lit("�"))


def _decode_piece(piece: Column) -> Column:
    """``piece`` is the text after one ``&``; unknown names stay as written."""
    number, name = F.regexp_extract(piece, ENTITY, 1), F.regexp_extract(piece, ENTITY, 2)
    value = (
        F.when(number.rlike("^#[xX]"), _code_point(F.substr(number, F.lit(3)), 16))
        .when(number != "", _code_point(F.substr(number, F.lit(2)), 10))
        .when(name == "amp", "&")
        .when(name != "", F.try_element_at(_named_entities(), name))
    )
    rest = F.substr(piece, F.length(F.regexp_extract(piece, ENTITY, 0)) + 1)
    return F.coalesce(F.concat(value, rest), F.concat(F.lit("&"), piece))


def decode_entities(text: Column) -> Column:
    """Character references to characters in one pass (``&amp;lt;`` becomes ``&lt;``)."""
    return F.transform(F.array(text), _decoded)[0]  # the text is computed once, whatever it is made of


def _decoded(text: Column) -> Column:
    common = text
    for reference, character in COMMON.items():
        common = F.replace(common, F.lit(reference), F.lit(character))
    pieces = F.split(text, "&")
    decoded = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode_piece(piece)))
    return (
        F.when(~text.contains("&"), text)
        .when(~text.rlike(OTHER_ENTITY), common)
        .otherwise(F.array_join(decoded, ""))
    )
