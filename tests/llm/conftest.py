import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from ``[(id, text), ...]``, with the columns of ``documents``."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src", None) for i, t in rows], COLUMNS)

    return make


@pytest.fixture(scope="session")
def tables():
    """Rows of a table of the smallest data set, read without Spark."""
    import duckdb

    return lambda sql: duckdb.sql(sql.replace("@", "/root/testdata/sf0.001/")).fetchall()
