from __future__ import annotations

import pytest

RULE = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """A frame of (doc_id, text) rows with extra columns whose names clash with results."""

    def make(*rows):
        df = spark.createDataFrame(list(rows), RULE)
        return df.selectExpr("*", "'x' AS kept", "1 AS n_words", "'y' AS score", "0 AS start")

    return make
