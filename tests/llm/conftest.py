import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that the operators use themselves.
CLASHING = {"stats": 1, "n_words": 2, "row": 3, "ids": 4, "epoch": 5, "weight": 6, "kept_lines": 7, "host": 8, "print": 9, "score": 10}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, very long, tied and repeated texts; null ids, languages and sources."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    same = "The quick brown fox jumps over the lazy dog while twelve more animals watch from the hill behind the old mill today."
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, long, "en", "a", len(long)),
            (5, same, "en", "b", len(same)), (5, same, "en", "b", len(same)), (6, same, None, None, None), (None, same, "en", "b", None),
            (7, "1234 5678", "de", "b", 9), (8, "é漢字😀 \x1c ​ a  b", "fr", "c", 14), (9, "one", "en", "c", 3), (10, "one", "en", "c", 3)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    from pyspark.sql import functions as F
    return odd_docs.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items()])


@pytest.fixture(scope="session")
def small(spark):
    import os
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables not available")
    return folder


@pytest.fixture(scope="session")
def small_docs(small):
    import duckdb
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{small}/documents.parquet' ORDER BY doc_id").fetchall()
