from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from conftest_rows import ROWS  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, component string, h1 int"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, copies, near copies, repeated rows, and columns that clash with results'."""
    rows = [(i, t, "en" if (i or 0) % 2 else None, "src1", len(t or ""), True, "x", 1) for i, t in ROWS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
