import pytest

from tests.conftest import spark  # noqa: F401


@pytest.fixture
def documents(spark):  # noqa: F811
    """A table of documents from (doc_id, text) rows, with further columns that must not matter."""

    def build(*rows):
        df = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
        return df.selectExpr("doc_id", "text", "'x' AS word", "1 AS n", "'y' AS anchor", "2 AS start", "3 AS length")

    return build


ODD = [
    (None, "no id at all"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one two three four five"),
    (6, "one two three four five"),
    (6, "one two three four five"),
    (7, "Ünï ÀÉ 🙂 the MIT License, 'quoted' it's 1.2.3.4 <|endoftext|>"),
    (8, "word " * 6000),
    (9, "a  b \n\n c   d\te   f\n g  "),
    (10, "The Quick brown fox. " * 40),
    (11, "The quick Brown fox! " * 40),
]
