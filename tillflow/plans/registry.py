"""The registry of queries over a test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillflow.plans.views import with_views
from tillflow.sources.adapters import TestTables

# Report parameters used by the registered queries.  The range leaves out the first weeks
# and the last months of the test tables, so that every dated query has rows on both sides
# to drop; ``AS_OF`` lies in the middle of them.
START, END = "1995-02-10", "2001-05-20"
AS_OF = "1998-07-01"
# Every date of the tables, for the queries that report on whole tables.
FIRST_DAY, LAST_DAY = "1990-01-01", "2030-12-31"
WEEKS = 13
SCENARIOS = ("base", "best", "worst")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[TestTables], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(TestTables(spark, folder))


QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[TestTables], DataFrame],
             oracle: str | None = None) -> None:
    """Add a query; ``oracle`` may name the views of ``plans.views``."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(name, build, with_views(oracle) if oracle else None)


def load() -> dict[str, Query]:
    """All registered queries."""
    from tillflow.plans import (dashboard, debt_plans, declared, forecasts,  # noqa: F401
                                ledger_reports, source_reports)
    return QUERIES
