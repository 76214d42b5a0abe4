import random

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_helpers import prose  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture
def documents(spark):
    """documents(texts) or documents([(id, text, source), ...])."""
    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, SCHEMA)
        from pyspark.sql import functions as F
        for name in extra:
            frame = frame.withColumn(name, F.lit("x"))
        return frame

    return make


@pytest.fixture
def odd_rows(rng):
    """Nulls in every column, empty, blank, repeated and very long texts."""
    long = prose(rng, 30_000)
    return [(1, None, None), (2, "", "b"), (3, "  \n\t ", "b"), (4, "one", None), (None, "one", "a"),
            (5, long, "a"), (6, long, "a"), (6, long, "a"), (None, None, None), (7, "É one TWO", "c")]
