import pytest
from samples import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, "
#: Names that operators use inside, as columns of the caller.
CLASHES = "id string, n string, set string, hash string, body string, words string, k string, t string, l string, x string, label string, score string, value string, entry string, bucket string, kept string, start string, offset string, features string, word string, found string, node string, component_id string, lang_pred string"
def rows_with_clashes(rows):
    return [(i, t, lang, "s", None if t is None else len(t), *[f"c{j}" for j in range(CLASHES.count(" string"))]) for i, t, lang in rows]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``, with clashing columns."""

    def made(rows):
        return spark.createDataFrame(rows_with_clashes([(*r, None)[:3] for r in rows]), SCHEMA + CLASHES)

    return made


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    base = prose(1, 60)
    return [
        (1, base, "xx"),
        (2, base, "xx"),
        (3, base + " tail", "xx"),
        (4, None, "xx"),
        (5, "", None),
        (6, " \n\t ", "xx"),
        (7, "one", "yy"),
        (7, "one", "yy"),
        (8, prose(2, 30_000), "xx"),
        (None, base, "xx"),
        (None, None, None),
        (9, "é è ñ ß 漢字 ​ 😀", "yy"),
        (10, "x" * 70_000, "yy"),
    ]
