"""Rows that the operators must stand, and fixtures that make tables of such rows."""

from __future__ import annotations

import pytest

from lakeloom.llm.workers import importable

# Extra columns whose names the operators use themselves.
CLASHING = "ids string, size string, bucket string, score string, component string, record string, place string"
SCHEMA = f"doc_id long, text string, lang string, source string, {CLASHING}"

ODD = [
    (1, "the quick brown fox jumps over the lazy dog " * 3),
    (1, "the quick brown fox jumps over the lazy dog " * 3),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "no id but words enough to have a shingle or two"),
    (None, None),
    (5, "Ümläut 漢字 😀 \x1c don't 12 £"),
    (6, "long " + "word another " * 60_000),
    (7, "x"),
]


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Makes documents of (doc_id, text) rows, with extra columns."""

    def make(*rows):
        return spark.createDataFrame([(i, t, "en", None, *"abcdefg") for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def odd(documents):
    return documents(*ODD)
