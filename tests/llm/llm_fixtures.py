"""A frame like ``documents`` for the tests of this folder."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("score", "value", "size", "row", "node", "spans", "words", "length", "copies", "kept", "key", "n", "label")


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a frame from tuples of id, text and source, with columns whose names clash with results."""

    def make(rows, lang="en"):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).withColumns({c: F.lit("x") for c in CLASHING})

    return make
