import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or "")) for r in rows], DOCS)

    return make


@pytest.fixture
def got():
    """Rows of a DataFrame by their first column."""
    return lambda df, *cols: {r[0]: tuple(r[1:]) for r in df.select(*cols).collect()}
