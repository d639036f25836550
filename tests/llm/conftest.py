import pytest


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


#: Null, empty, blank, short, tied and repeated rows; extra columns with clashing names.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, " \t\n "), (None, "the quick brown fox jumps over the lazy dog"),
    (None, None), (5, "THE QUICK brown fox jumps over the lazy dog"), (6, "one"), (6, "one"), (7, "é" * 50 + "\n" + "x"), (-9, "one two three"),
]


@pytest.fixture()
def odd(spark):
    rows = [(i, t, "n", 1, 2, 0.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_lines int, size int, score double")
