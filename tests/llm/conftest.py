import pytest

import lumetric.llm.queries  # noqa: F401  registers the functions that travel to workers

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, key int, hash int, w string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000))
    lines = "first line here\nsecond line here\nthird line here\nfourth line"
    extra = (7, "x", 3, 4, "y")
    rows = [
        (1, lines, "en", "a", 10, *extra),
        (2, "new\n" + lines, "en", "a", 10, *extra),
        (2, "new\n" + lines, "en", "a", 10, *extra),
        (3, "", "fr", "b", 0, *extra),
        (4, None, "fr", "b", None, *extra),
        (None, "text without an id, one two three", "fr", None, 3, *extra),
        (None, None, None, None, None, None, None, None, None, None),
        (5, long, "en", None, 9, *extra),
        (6, "one", None, "c", 3, *extra),
        (7, "one", "en", "c", 3, *extra),
        (8, "   \n\t ", "en", "c", 3, *extra),
        (9, "é\U0001f600 ünïcode\x00 ퟿", "de", "é", 3, *extra),
        (10, "x\ny\nx\ny\nx\ny\nx\ny", "de", "a", 3, *extra),
    ]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KINDS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")
