from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import prose  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, kept string, score string, label string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with columns that clash with outputs."""

    def make(rows, source="s"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else source, 0, "a", "b", "c", "d") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def edges():
    """Ids and texts: nulls, empty, blank, very long, repeated rows and ties."""
    long = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "short"), (6, "short"), (6, "other text"),
        (7, "é" * 5000), (None, "no id but words enough to be seen"), (None, None), (8, "😀 名前 ﬁ"),
    ]
