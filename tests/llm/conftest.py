import pytest

TEXTS = (None, "", " \n", "a", "one two three", "Ünïcode façade 日本語 👍  x")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def docs(rows, lang=None):
        schema = "doc_id long, text string, lang string, source string, n_chars long, key string, node long, score string, predicted string, start string"
        full = [(i, t, lang[k] if lang else "en", "s", len(t) if t else None, "k", 1, "x", "y", "z") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, schema)

    return docs
