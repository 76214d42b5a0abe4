"""Date expressions: ranges, weeks, month arithmetic, business days."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str


def date_lit(value: DateLike) -> Column:
    return F.lit(str(value)).cast("date")


def all_of(conditions: list[Column]) -> Column:
    """AND of optional predicates; TRUE when there is none."""
    return reduce(and_, conditions, F.lit(True)) if conditions else F.lit(True)


def day_between(day: Column, start: DateLike | None, end: DateLike | None) -> Column:
    """Inclusive day range with optional ends.

    ``to_date(ts) >= d`` is unwrapped by Catalyst, so the range still reaches
    the Parquet scan when ``day`` is a timestamp cast to a date.
    """
    conditions = []
    if start is not None:
        conditions.append(day >= date_lit(start))
    if end is not None:
        conditions.append(day <= date_lit(end))
    return all_of(conditions)


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", day).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def weeks_before(as_of: DateLike, weeks: int) -> Column:
    return F.date_sub(date_lit(as_of), 7 * weeks)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def next_weekday(day: Column) -> Column:
    """Saturday and Sunday move to Monday."""
    return (F.when(F.dayofweek(day) == 7, F.date_add(day, 2))
            .when(F.dayofweek(day) == 1, F.date_add(day, 1))
            .otherwise(day))


def previous_weekday(day: Column) -> Column:
    """Saturday and Sunday move to Friday."""
    return (F.when(F.dayofweek(day) == 7, F.date_sub(day, 1))
            .when(F.dayofweek(day) == 1, F.date_sub(day, 2))
            .otherwise(day))
