from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def make(pairs, extra=True):
        frame = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], DOC_SCHEMA
        )
        if not extra:
            return frame
        for name in ("n_words", "score", "size", "slot", "spans", "base", "ids", "class_id", "text_hash"):
            frame = frame.selectExpr("*", f"'other' as {name}")
        return frame

    return make
