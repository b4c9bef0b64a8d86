from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with a clashing extra column, nulls, empties, repeated rows and a long text."""

    def build(*rows, extra="n int, size string"):
        return spark.createDataFrame([(*r, 1, "x") for r in rows], f"doc_id long, text string, lang string, source string, {extra}")

    return build
