import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with extra columns whose names clash with those the operators make."""

    def make(rows):
        table = spark.createDataFrame([(i, t, lang, src, len(t) if t else None) for i, t, lang, src in rows], DOCS)
        for name in ("row", "fp", "size", "draw", "kept", "score", "spans", "words", "digest", "place", "k1", "n_words"):
            from pyspark.sql import functions as F

            table = table.withColumn(name, F.lit("clash"))
        return table

    return make


# Nulls in every column, empty and blank texts, repeated rows, one text under several ids, a text of a single letter.
ODD = [
    (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "x", "en", "b"), (4, "x", "en", "b"),
    (None, "a text without an id, and of some words", "de", None), (5, "a text without an id, and of some words", "de", "b"),
    (6, "ÄÖÜ ß € 😀 İ Σ", "de", "c"), (7, "word " * 60, "en", "c"),
]
__all__ = ["ODD", "Row"]
