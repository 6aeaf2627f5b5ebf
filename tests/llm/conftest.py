import os
import sys

import pytest

os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), os.environ.get("PYTHONPATH", "")]
)
sys.path.insert(0, os.environ["PYTHONPATH"].split(os.pathsep)[0])

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words bigint, score double, `row` string"


@pytest.fixture
def docs(spark):
    """Documents from texts or (doc_id, text, lang); the table has columns that clash with the operators' own."""

    def build(*rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, lang = r if isinstance(r, tuple) else (i, r, "en")
            full.append((doc_id, text, lang, "s", 7, 0.5, "x"))
        return spark.createDataFrame(full, SCHEMA)

    return build


#: Nulls in every column, empty, blank, long, repeated and tied rows.
AWKWARD = (
    (None, None, None),
    (None, "a null id but some words to go with it here", "en"),
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, "one", "en"),
    (5, "same text as the next row\nand a second line", "en"),
    (5, "same text as the next row\nand a second line", "en"),
    (6, "same text as the next row\nand a second line", "fr"),
    (7, "word " * 60_000, "en"),
    (8, "x" * 300_000, "de"),
    (9, "  leading, double  blanks   and <|endoftext|> marks \n\n", "en"),
    (10, "émile ÉMILE é 日本語 🙂 \x1f \x85 end", "fr"),
)
