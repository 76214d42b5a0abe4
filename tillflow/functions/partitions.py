"""How rows are dealt over tasks before a step that makes many rows of each."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by ``keys`` over as many tasks as the session shuffles into.

    Adaptive execution would merge small partitions by what comes in, however much a task
    then makes of it; a stated number it leaves alone.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
