import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    from quipu.llm.common import importable

    importable(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "The quick brown fox jumps over the lazy dog and runs. " * 4000


@pytest.fixture
def make(spark):
    """A documents table from (doc_id, text) pairs or full rows; clashing extra columns on request."""

    def build(rows, extra=()):
        full = [(r + ("en", "s", len(r[1] or "")) if len(r) == 2 else r) + tuple(7 for _ in extra) for r in rows]
        return spark.createDataFrame(full, ", ".join([DOCS, *[f"`{c}` int" for c in extra]])).repartition(3)

    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, repeated rows and equal texts."""
    return [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "one", None, "s", 3),
        (4, LONG, "en", None, len(LONG)),
        (5, LONG, "en", "s", len(LONG)),
        (6, "naïve café – 文字 🙂 \t\n mixed\x00text", "fr", "s", 1),
        (6, "naïve café – 文字 🙂 \t\n mixed\x00text", "fr", "s", 1),
        (None, "no id at all", "en", "s", 12),
        (7, "   \n\t ", "en", "s", 6),
    ]


@pytest.fixture
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")
