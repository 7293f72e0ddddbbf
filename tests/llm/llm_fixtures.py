"""Fixtures shared by the tests of the training-data operators."""

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, lang, source])."""
    def make(rows):
        rows = [(*r, *("en", "src0")[len(r) - 2:]) for r in rows]
        return spark.createDataFrame([(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")
    return make
