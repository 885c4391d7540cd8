"""Entity spans in documents and questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import entities as N
from workload import Catalogue, spread_table

catalogue = Catalogue()

# Names that occur in the test texts, with repeats and names inside names.
NAMES = [
    ("Apache", "ORG"),
    ("Apache License", "LAW"),
    ("MIT", "ORG"),
    ("MIT License", "LAW"),
    ("GNU", "ORG"),
    ("General Public License", "LAW"),
    ("GNU General", "ORG"),
    ("CC BY-NC 4.0", "LAW"),
    ("Orre", "ORG"),
    ("Orre Orre", "ORG"),
    ("Stteen Erachtz", "PERSON"),
    ("Eriner", "ORG"),
    ("Ci", "GPE"),
    ("Is", "ORG"),
    ("Der", "ORG"),
    ("Que", "ORG"),
    ("the of", "ORG"),
    ("of the", "ORG"),
    ("example.com", "ORG"),
    (".NET", "PRODUCT"),
    ("$AAPL", "ORG"),
    ("| the", "DET"),
    ("THE!!", "DET"),
    ("&&& the", "DET"),
]
OVERRIDES = [("License", "NORP"), ("Orre", "WORK"), ("the", "DET")]

# The SQL side has its own idea of a word.
SQL_WORD = "[\\pL\\pM\\pN_]"
SQL_PIECE = "(?s)[\\pL\\pM\\pN_]+|[^\\pL\\pM\\pN_]+"


def sql_names(names: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{name}', '{label}')" for name, label in names)


def sql_spans(prefix: str, relation: str, keys: str, names: list[tuple[str, str]]) -> str:
    """CTEs ``{prefix}``: spans by a walk over all candidates from left to right."""
    on = " AND ".join(f"s.{k} = w.{k}" for k in keys.split(", "))
    same = " AND ".join(f"l.{k} = n.{k}" for k in keys.split(", "))
    walked = ", ".join(f"w.{k}" for k in keys.split(", "))
    picked = ", ".join(f"l.{k}" for k in keys.split(", "))
    return f"""
    {prefix}_names(name, label) AS (VALUES {sql_names(names)}),
    {prefix}_sized AS (SELECT name, label, len(regexp_extract_all(name, '{SQL_WORD}+')) AS m,
                              length(regexp_extract(name, '^[^\\pL\\pM\\pN_]*')) AS before,
                              regexp_extract(name, '{SQL_WORD}+') AS word FROM {prefix}_names),
    {prefix}_split AS (SELECT {keys}, regexp_extract_all(body, '{SQL_PIECE}') AS p FROM {relation}),
    {prefix}_pieces AS (SELECT {keys}, unnest(p) AS piece, unnest(range(len(p))) AS pos FROM {prefix}_split),
    {prefix}_placed AS (
        SELECT *, CAST(coalesce(sum(length(piece)) OVER (PARTITION BY {keys} ORDER BY pos
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM {prefix}_pieces
    ),
    {prefix}_hit AS (SELECT * FROM {prefix}_placed JOIN {prefix}_sized ON piece = word),
    {prefix}_found AS (
        SELECT {keys}, name AS text, start - before AS start, start - before + length(name) AS stop, label,
               pos // 2 AS start_token, pos // 2 + m AS end_token
        FROM {prefix}_hit JOIN {relation} USING ({keys})
        WHERE start >= before AND substr(body, start - before + 1, length(name)) = name
          AND (NOT regexp_matches(name, '{SQL_WORD}$')
               OR NOT regexp_matches(substr(body, start - before + 1 + length(name), 1), '{SQL_WORD}'))
    ),
    {prefix}_longest AS MATERIALIZED (
        SELECT * FROM {prefix}_found
        QUALIFY row_number() OVER (PARTITION BY {keys}, start ORDER BY stop DESC, label) = 1
    ),
    {prefix}_walk AS (
        SELECT l.* FROM {prefix}_longest l
        WHERE start = (SELECT min(start) FROM {prefix}_longest n WHERE {same})
        UNION ALL
        SELECT l.* FROM (
            SELECT {walked}, min(s.start) AS next_start
            FROM {prefix}_walk w JOIN {prefix}_longest s ON {on} AND s.start >= w.stop
            GROUP BY {walked}
        ) n JOIN {prefix}_longest l ON {same} AND l.start = n.next_start
    ),
    {prefix} AS (SELECT {picked}, l.text, l.start, l.stop, l.label, l.start_token, l.end_token FROM {prefix}_walk l)
    """


COLUMNS = """
    doc_id, text, CAST(start AS INTEGER) AS "start", CAST(stop AS INTEGER) AS "end", label,
    CAST(start_token AS INTEGER) AS start_token, CAST(end_token AS INTEGER) AS end_token
"""
DOCS = "docs AS (SELECT doc_id, text AS body FROM documents),"


def names(spark, rows=None):
    return spark.createDataFrame(rows or NAMES, "name string, label string")


def spans(spark, sf_dir):
    return N.tag_entities(spread_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", names(spark))


@catalogue.query(f"WITH RECURSIVE {DOCS} {sql_spans('base', 'docs', 'doc_id', NAMES)} SELECT {COLUMNS} FROM base")
def entity_spans(spark, sf_dir):
    return spans(spark, sf_dir)


@catalogue.query(f"""
    WITH RECURSIVE {DOCS} {sql_spans('base', 'docs', 'doc_id', NAMES)} SELECT {COLUMNS} FROM base WHERE label = 'ORG'
""")
def organisation_spans(spark, sf_dir):
    return N.with_label(spans(spark, sf_dir), "ORG")


@catalogue.query(f"""
    WITH RECURSIVE {DOCS} {sql_spans('base', 'docs', 'doc_id', NAMES)}, {sql_spans('ov', 'docs', 'doc_id', OVERRIDES)},
    merged AS (
        SELECT * FROM ov UNION ALL
        SELECT * FROM base b WHERE NOT EXISTS (
            SELECT 1 FROM ov o WHERE o.doc_id = b.doc_id AND o.start < b.stop AND b.start < o.stop)
    )
    SELECT {COLUMNS} FROM merged
""")
def entity_override(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    overrides = N.tag_entities(docs, "doc_id", "text", names(spark, OVERRIDES))
    return N.override_spans(spans(spark, sf_dir), overrides, ["doc_id"])


@catalogue.query(f"""
    WITH RECURSIVE {DOCS} {sql_spans('base', 'docs', 'doc_id', NAMES)}, {sql_spans('ov', 'docs', 'doc_id', OVERRIDES)},
    merged AS (
        SELECT * FROM ov UNION ALL SELECT * FROM base WHERE doc_id NOT IN (SELECT doc_id FROM ov)
    )
    SELECT {COLUMNS} FROM merged
""")
def entity_replacement(spark, sf_dir):
    """Texts with overrides have these as their complete list."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text")
    complete = N.tag_entities(docs, "doc_id", "text", names(spark, OVERRIDES))
    return N.replace_spans(spans(spark, sf_dir), complete, ["doc_id"])


@catalogue.query(f"""
    WITH RECURSIVE asked AS (SELECT conv_id, turn, text AS body FROM conversations WHERE role = 'user'),
    {sql_spans('base', 'asked', 'conv_id, turn', NAMES)}
    SELECT conv_id, turn, arg_min(text, start) AS company FROM base WHERE label = 'ORG' GROUP BY conv_id, turn
""")
def company_of_question(spark, sf_dir):
    questions = spread_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").filter(F.col("role") == "user")
    return N.company_of_question(questions, ["conv_id", "turn"], "text", names(spark))
