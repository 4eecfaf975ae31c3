"""Small documents with the awkward cases every operator must take."""

import pytest

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nShort one.", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today.\nOther.", "en", "a", 5),
    (3, None, "en", "b", None),
    (4, "", None, None, 0),
    (5, " \n\t \n", "fr", "b", 6),
    (6, "word " * 3000, "en", "a", 15000),
    (7, "x" * 50_000, "de", "c", 50_000),
    (None, "A row without an id, but with words enough to be told apart from the rest.", "en", "a", 9),
    (8, "Same text.", "en", "a", 1),
    (8, "Same text.", "en", "a", 1),
    (9, "Same text.", "en", "b", 1),
    (10, "Ünïcödé – 日本語 😀 text\u2028with odd\x00 marks", "de", "c", 2),
]


@pytest.fixture(scope="session")
def docs(spark):
    # Extra columns whose names the operators use inside.
    rows = [(*r, f"n{i}", i) for i, r in enumerate(DOCS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                       "n_chars bigint, node string, row int")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
