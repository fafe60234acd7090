from __future__ import annotations

import pytest
from brute import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, group string, size long, n long, token string, component long"

def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, copies, near copies and a repeated row."""
    base = prose(1, 120)
    texts = [None, "", "  \n\t ", "one", "two words", base, base, base.replace("alpha", "ALPHA"), base + " tail", prose(2, 300), prose(3, 30_000), "日本語 текст é 😀 \x1c x", "a\nb\nc\n" + prose(4, 40), "!!! ??? 123"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", len(t) if t else None, "g", 7, None, "t", None) for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base, None, None, None, None, None, None, None, None), (-4, prose(9, 60), "en", "", 1, None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with every awkward case, and further columns named like ours."""
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
