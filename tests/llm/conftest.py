import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import DOCS, text  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs in every column, empty, blank and long texts, ties and repeated rows."""
    long_text = text(1, 6_000)
    rows = [
        (1, text(2, 80), "en", "a", 1), (2, text(2, 80), "en", "b", 2), (2, text(2, 80), "en", "b", 2),
        (3, text(2, 80) + " tail end", None, None, None), (4, "", "en", "a", 0), (5, None, "en", "a", None),
        (6, " \n\t ", "de", None, 3), (7, long_text, "en", "c", 7), (8, long_text.upper(), "en", "c", 8),
        (9, long_text + " " + text(3, 30), "fr", "", 9), (None, text(2, 80), "en", "a", 10), (None, None, None, None, None),
        (10, "one", "en", "d", 3), (11, "one two", "en", "d", 7), (12, "one two \U0001f600 ▁x\x00y", "xx", "é", 12),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd documents with extra columns whose names operators use for their own results."""
    from pyspark.sql import functions as F

    names = "id n size shard slot law target source_size taken token df digest node key place comp root u v doc z lo hi ranges kept score i q w t"
    return odd.select("*", *[F.lit("x").alias(c) for c in names.split()])
