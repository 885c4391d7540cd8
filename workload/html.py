"""Page fields: title, headings, paragraphs, soft error pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import html
from pagemill.operators import pages as P
from workload import Catalogue, spread_table

catalogue = Catalogue()

# The SQL side reads the pages in its own way: text and inline tags after an opening tag, up to any other tag.
CLEANED = r"""
    SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                   '(?si)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS c FROM pages
"""


def sql_decoded(text: str) -> str:
    """The entities the test pages use, ``&amp;`` last."""
    entities = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&nbsp;": " ", "&copy;": "©", "&middot;": "·"}
    for name, character in [*entities.items(), ("&amp;", "&")]:
        text = f"replace({text}, '{name}', '{character}')"
    return text


INLINE = "(?:[^<]|<b>|</b>|<br>|<i>|</i>|<em>|</em>|<a [^>]*>|</a>)*"
TITLE = f"coalesce({sql_decoded("regexp_extract(c, '<title>([^<]*)</title>', 1)")}, '')"
PLAIN = sql_decoded("regexp_replace(x, '</?[a-z]+[^>]*>', '', 'g')")
HEADINGS = f"list_transform(regexp_extract_all(c, '<h[1-6]>({INLINE})</h', 1), lambda x: {PLAIN})"
PARAGRAPHS = f"list_transform(regexp_extract_all(c, '<p>({INLINE})', 1), lambda x: {PLAIN})"


@catalogue.query(f"""
    WITH cleaned AS ({CLEANED})
    SELECT page_id, {TITLE} AS title,
           CAST(len({HEADINGS}[1:10]) AS BIGINT) AS n_headings,
           CAST(len({PARAGRAPHS}[1:10]) AS BIGINT) AS n_paragraphs,
           {PARAGRAPHS}[1] AS first_paragraph
    FROM cleaned
""")
def page_fields(spark, sf_dir):
    pages = spread_table(spark, sf_dir, "pages", "page_id", "html")
    return P.with_html_fields(pages, "html").select(
        "page_id",
        "title",
        F.size("title_content").cast("bigint").alias("n_headings"),
        F.size("body_content").cast("bigint").alias("n_paragraphs"),
        F.get("body_content", F.lit(0)).alias("first_paragraph"),
    )


@catalogue.query(f"WITH cleaned AS ({CLEANED}) SELECT page_id, {TITLE} AS title FROM cleaned")
def html_title(spark, sf_dir):
    clean = html.clean_html(F.col("html"))
    return spread_table(spark, sf_dir, "pages", "page_id", "html").select("page_id", html.html_title(clean).alias("title"))


@catalogue.query(f"""
    WITH cleaned AS ({CLEANED}), found AS (SELECT page_id, {HEADINGS}[1:10] AS h FROM cleaned)
    SELECT page_id, unnest(h) AS heading, unnest(range(len(h))) AS heading_no FROM found
""")
def html_headings(spark, sf_dir):
    headings = html.html_headings(html.clean_html(F.col("html")))
    rows = spread_table(spark, sf_dir, "pages", "page_id", "html").select("page_id", F.posexplode(headings).alias("heading_no", "heading"))
    return rows.withColumn("heading_no", F.col("heading_no").cast("bigint"))


@catalogue.query(f"""
    WITH cleaned AS ({CLEANED}), found AS (SELECT page_id, {PARAGRAPHS}[1:10] AS p FROM cleaned)
    SELECT page_id, unnest(p) AS paragraph, unnest(range(len(p))) AS paragraph_no FROM found
""")
def html_paragraphs(spark, sf_dir):
    paragraphs = html.html_paragraphs(html.clean_html(F.col("html")))
    rows = spread_table(spark, sf_dir, "pages", "page_id", "html").select("page_id", F.posexplode(paragraphs).alias("paragraph_no", "paragraph"))
    return rows.withColumn("paragraph_no", F.col("paragraph_no").cast("bigint"))


@catalogue.query(f"""
    WITH cleaned AS ({CLEANED}), found AS (SELECT page_id, {PARAGRAPHS} AS p FROM cleaned)
    SELECT page_id, unnest(p) AS text, unnest(range(len(p))) AS chunk_no FROM found
""")
def html_all_paragraphs(spark, sf_dir):
    chunks = P.paragraph_chunks(spread_table(spark, sf_dir, "pages", "page_id", "html"), "page_id", "html")
    return chunks.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


# The SQL engine's levenshtein counts bytes; folding each other character to one ``?`` gives characters again,
# because no template holds a ``?``.
FOLDED = f"regexp_replace(lower(trim({TITLE})), '[^\\x00-\\x7F]', '?', 'g')"
ERROR_TITLES = "404 not found|page not found|error 404|not found"
SCORES = ", ".join(
    f"1 - levenshtein(t, '{template}') / CAST(greatest(length(t), {len(template)}) AS DOUBLE)"
    for template in ERROR_TITLES.split("|")
)


@catalogue.query(f"""
    WITH cleaned AS ({CLEANED}), folded AS (SELECT page_id, {FOLDED} AS t FROM cleaned)
    SELECT page_id, round(greatest({SCORES}), 6) AS score, greatest({SCORES}) >= 0.8 AS is_not_found FROM folded
""")
def not_found_pages(spark, sf_dir):
    title = html.html_title(html.clean_html(F.col("html")))
    scored = spread_table(spark, sf_dir, "pages", "page_id", "html").select("page_id", title.alias("title")).select(
        "page_id", P.not_found_score(F.col("title")).alias("raw")
    )
    return scored.select("page_id", F.round("raw", 6).alias("score"), (F.col("raw") >= 0.8).alias("is_not_found"))
