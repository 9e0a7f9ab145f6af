"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

CLASHES = ["size", "shard", "slot", "digest", "pos", "words", "label", "rank", "block", "score", "spans", "kept", "row_id", "target", "key", "tree"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents_of(spark):
    """Documents from (doc_id, text[, source]) rows, with clashing extra columns."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        return frame.withColumns({c: F.lit("x") for c in CLASHES}) if extra else frame

    return make


@pytest.fixture(scope="session")
def messy(documents_of):
    """Null ids, null and empty texts, repeated rows, a long text, letters beyond ASCII."""
    long = "alpha beta gamma delta " * 5000 + "released under the MIT License. token = 'abcdef123456'"
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "no id here"), (None, None), (2, None), (3, ""), (4, " \n\t"), (5, long), (6, "É İ K über straße 😀 mit\u212a license")]
    return documents_of(rows)


def shingles_of(text):
    """Five-word shingles of a text."""
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
