import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank at dusk"


def row(doc_id, text, source="s", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white-space texts, a very long text, ties and repeated rows."""
    long_text = " ".join(f"word{k % 977} and{k % 13}" for k in range(60_000))
    rows = [
        row(1, PLAIN),
        row(2, PLAIN),
        row(2, PLAIN),
        row(3, None),
        row(4, ""),
        row(5, " \t\n"),
        row(None, PLAIN + " again"),
        row(None, None, None, None),
        row(6, long_text),
        row(7, "ünïcödé ñandú 日本語 \u00a0 nbsp " * 20),
        row(8, PLAIN.upper(), None),
        row(9, "x"),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 1), (9, 0, None), (None, 1, 1), (7, None, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
