import pytest

LONG = "word " * 60_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    prose = "the quick brown fox jumps over a lazy dog near the river bank while seven wizards sing old songs "
    rows = [
        (1, prose * 4, "en", "a", 7, "x"),
        (1, prose * 4, "en", "a", 7, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "", 0, "y"),
        (None, "no id at all", "en", "b", 1, "z"),
        (5, LONG, "en", "a", len(LONG), "w"),
        (6, " \n\t\n ", "de", "c", 3, "v"),
        (7, "A" * 50_000, "de", "c", 3, "v"),
        (8, "naïve – ☃ 雪 \U0001f600 x@y.zz\r\nnext", "zh", "c", 3, "v"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def small(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()
