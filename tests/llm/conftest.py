import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, fp long, component string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 977} filler{i}" for i in range(30_000))
    rows = [
        (1, "A plain text about rivers and hills and towns", "en", "s0", 45, 0.5, "x", 7, "c"),
        (1, "A plain text about rivers and hills and towns", "en", "s0", 45, 0.5, "x", 7, "c"),
        (2, "A plain text about rivers and hills and towns", "en", "s0", 45, 0.5, "x", 7, "c"),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "en", "s1", 0, 0.1, "y", 0, "d"),
        (5, " \t\n ", "en", "s1", 4, 0.1, "y", 0, "d"),
        (6, long, "en", None, len(long), 0.1, "y", 0, "d"),
        (7, "x" * 200_000, "en", "s0", 200_000, 0.1, "y", 0, "d"),
        (None, "No key but a text", "en", "s0", 17, 0.1, "y", 0, "d"),
        (None, None, None, None, None, None, None, None, None),
        (8, "Überall schöne Wörter, café <|endoftext|> 漢字 🙂", "de", "s2", 44, 0.1, "y", 0, "d"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 1), (2, None, None), (2, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
