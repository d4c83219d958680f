import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martflow.llm.common import prepare

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def prepared(spark):
    return prepare(spark)


@pytest.fixture
def documents(prepared):
    """A documents table from (id, text) or (id, text, lang, source) rows."""

    def build(rows, extra=""):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        return prepared.createDataFrame(full, DOC)

    return build


# Null ids and texts, empty text, ties, repeated rows, a long text, other scripts.
AWKWARD = [
    (1, None, None, None),
    (2, "", "en", None),
    (None, "the same words again and again here", "en", "a"),
    (3, "the same words again and again here", "en", "a"),
    (3, "the same words again and again here", "en", "a"),
    (4, "THE same words again and again here", "de", "a"),
    (5, " \t\n", "en", "b"),
    (6, "x", None, "b"),
    (7, "word%d " * 3 + " ".join(f"w{i}" for i in range(30_000)), "en", "c"),
    (8, "日本語 текст ñandú 😀", "es", "c"),
]
