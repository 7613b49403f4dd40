from __future__ import annotations

import random

import pytest

from skyfold.llm.common import Scratch

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented words in lines of a dozen."""
    r = random.Random(seed)
    chosen = [f"w{r.randrange(vocabulary)}" + "é" * (r.random() < 0.1) for _ in range(words)]
    return "\n".join(" ".join(chosen[i : i + 12]) for i in range(0, words, 12))
