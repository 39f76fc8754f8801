import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, pos int, __x double"


@pytest.fixture(scope="session")
def documents(spark):
    """(id, text) pairs -> documents with extra columns whose names clash with those the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src1", None if t is None else len(t), "w", 1, 0.5) for i, t in rows], DOCS)

    return make
