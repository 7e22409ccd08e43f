from __future__ import annotations

import os
import random

import pytest

SMALL = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test data")
    return SMALL


@pytest.fixture
def documents(spark):
    """Build a table of documents from texts, numbered from 0."""

    def build(*texts, **more):
        rows = [(i, text, *more.values()) for i, text in enumerate(texts)]
        extra = "".join(f", `{name}` string" for name in more)
        return spark.createDataFrame(rows, f"doc_id bigint, text string{extra}")

    return build


@pytest.fixture
def words():
    """Random texts of made-up words, repeatable."""
    rng = random.Random(5)
    stock = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]

    def text(n):
        return " ".join(rng.choice(stock) for _ in range(n))

    return text
