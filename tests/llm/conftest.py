from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key bigint, label string, words bigint"


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 1, "x", 2) for i, t in rows], DOCS)

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls, empty and very long texts, repeats, odd characters."""
    long = "the long road of words " * 4000
    rows = [(5, "plain words here and more of them"), (1, None), (2, ""), (3, "   "), (7, long), (4, "plain words here and more of them"), (4, "plain words here and more of them"), (9, "Ünïcode 日本語 ▁ x²   \n\n tail  "), (None, "no id"), (11, "x" * 5000)]
    return make_docs(rows)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])
