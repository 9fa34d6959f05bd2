import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text, source) as a documents-like table with an extra, clashing column name."""
    def make(rows):
        return spark.createDataFrame([(i, t, s, "x") for i, t, s in rows],
                                     "doc_id long, text string, source string, digest string")
    return make
