from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of ids and texts as a documents table."""

    def make(*rows):
        filled = [(*row, "en", "s", len(row[1] or ""))[:5] if len(row) == 2 else row for row in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return make
