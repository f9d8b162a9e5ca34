import pytest


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) as documents with extra columns whose names clash with names the operators use."""

    def make(rows):
        rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", 1, "r") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key int, text_hash string")

    return make
