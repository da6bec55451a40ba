from __future__ import annotations

import pytest

from tallyspark.llm.common import text_or_empty  # noqa: F401  (the subpackage must import)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, rep long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents frame from (doc_id, text) or (doc_id, text, lang) rows, with
    extra columns whose names the operators use inside."""

    def frame(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, "x", 7) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3) if full else spark.createDataFrame([], SCHEMA)

    return frame
