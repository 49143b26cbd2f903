import random

import pytest

EXTRA = "1 as uid, 'x' as row, 2 as key, 3 as h, 'y' as mark, 4 as size, 5 as w, 'z' as t, 6 as n, 7 as __id, 'q' as base, 8 as block"


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words by a seed."""

    def make(seed: int, n: int, vocabulary: int = 4000) -> str:
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(vocabulary)}{'.' if r.random() < 0.08 else ''}" for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and columns whose names clash."""
    long = "word " * 30000 + "1.2.3.4 " + "9" * 4000 + " a@b.co"
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 4), (4, long, "en", "b", len(long)), (5, "same text here", "en", "b", 14), (5, "same text here", "en", "b", 14), (5, "another of that id", "de", "b", 18), (6, "é😀 ü x@y.z", "fr", "", None), (None, "no id 4111 1111 1111 1111", "en", "c", 25)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return d.selectExpr("*", *EXTRA.split(", "))
