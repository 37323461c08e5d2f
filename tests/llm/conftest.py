import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import edge_texts, make_docs  # noqa: E402


@pytest.fixture(scope="session")
def texts():
    return edge_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i * 3, t, "en", ["a", "b", None, "c"][i % 4] if i % 5 else "a") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, texts[3]), (None, None), (7, "one two three")]
    return make_docs(spark, rows)
