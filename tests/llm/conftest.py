import pytest

#: Columns that operators use inside, here as extra columns of the input.
CLASHING = ["fp", "root", "length", "salt", "nth", "chunk", "words", "score", "label", "half", "digest", "body", "classes", "n", "chunks", "row", "n_removed", "own_fp"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, one id with two texts, and extra columns."""
    long = " ".join(f"wörd{i % 977}x{i}" for i in range(6000))
    rows = [
        (1, "The cat sat on the mat and it was a good day for all of the people in the town that is by the sea"),
        (2, None), (3, ""), (None, "a text without an id"), (None, None), (4, long), (5, "   \n\n \t"), (6, "x"), (6, "x"),
        (7, "same id, one text"), (7, "same id, another text"), (8, "日本語 テキスト 🙂 é"), (9, "line one\nline two\nline three\n" * 3),
        (10, "a" * 5000), (11, "x"),
    ]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["extra"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id < -1")


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None), (3, 0, 1), (3, 1, 1), (99, 7, 7)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, tables):
    return spark.read.parquet(f"{tables}/labels.parquet")


@pytest.fixture(scope="session")
def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]
