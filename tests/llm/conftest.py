import pytest


@pytest.fixture
def no_rows(spark):
    """An empty documents table."""
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def make_docs(spark):
    """Documents from texts (ids in order) or (id, text) pairs."""
    def make(texts):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long")
    return make
