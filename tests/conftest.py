import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tillflow.session import build_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tillflow.sources.adapters import TestTables

    return TestTables(spark, FOLDER)


@pytest.fixture
def frame(spark):
    """frame(schema, row, row, ...) -> DataFrame, dates given as text."""
    from pyspark.sql import functions as F

    def make(schema, *rows):
        kinds = dict(part.split() for part in schema.split(","))
        timed = {n: k for n, k in kinds.items() if k in ("date", "timestamp")}
        plain = ", ".join(f"{n} {'string' if n in timed else k}" for n, k in kinds.items())
        df = spark.createDataFrame(list(rows), plain)
        return df.withColumns({n: F.col(n).cast(k) for n, k in timed.items()}) if timed else df

    return make
