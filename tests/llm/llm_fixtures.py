import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(rows, lang=None):
        return spark.createDataFrame(
            [(d, t, lang, "s", None if t is None else len(t), "x", 1, True) for d, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, key string, text_hash int, kept boolean")
    return make
