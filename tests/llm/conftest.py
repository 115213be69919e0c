import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="session")
def tables(spark, testdata):
    return lambda name: spark.read.parquet(f"{testdata}/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and a column with a clashing name."""
    same = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, same), (6, same), (6, same), (None, same),
        (None, None), (7, "word " * 40_000), (8, "\n".join([same] * 3)), (9, "…é😀 " * 30),
    ]
    return spark.createDataFrame([(d, t, None, None, None, "x") for d, t in rows], DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
