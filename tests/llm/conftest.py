import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, an empty and a very long text, repeated rows, and columns that clash with outputs."""
    long = " ".join(f"word{i % 7000}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, None), (None, "some text without an id"), (4, "short"),
        (5, long), (6, long), (7, "twice the same row " * 20), (7, "twice the same row " * 20), (8, "Ünï©ode 😀 " * 60),
    ]
    rows = [(i, t, None if i == 4 else "en", None, True, 7, "x", 1.5, "e", 2, "h", 9, "t") for i, t in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, kept boolean, n_words int, labels string, score double, "
        "_email string, _new int, _hits string, _q_n_words int, _text string",
    )
