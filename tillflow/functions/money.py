"""Exact money arithmetic on FLOAT64 columns.

Source tables carry money as doubles.  Adding doubles gives a result that
depends on the order in which partial sums meet, so a shuffle can change the
last digits.  All sums here run on 64-bit integers of 1/10,000 currency unit:
exact, order-independent and kept in whole-stage code generation.  Under ANSI
mode a total beyond 9.2e14 units of currency raises instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_CURRENCY = 10_000.0


# Column names become SQL text: one call into the JVM instead of one per
# operator, which matters when a report builds dozens of sums.

def _units_sql(name: str) -> str:
    return f"CAST(rint(CAST(`{name}` AS DOUBLE) * {UNITS_PER_CURRENCY}D) AS BIGINT)"


def _currency_sql(whole: str) -> str:
    return f"CAST({whole} AS DOUBLE) / {UNITS_PER_CURRENCY}D"


def units(amount: Column | str) -> Column:
    """Money as a whole number of 1/10,000 units; NULL stays NULL."""
    if isinstance(amount, str):
        return F.expr(_units_sql(amount))
    return F.rint(amount.cast("double") * UNITS_PER_CURRENCY).cast("bigint")


def from_units(whole: Column) -> Column:
    return whole.cast("double") / UNITS_PER_CURRENCY


def money_sum(amount: Column | str) -> Column:
    """SUM over money, exact; NULL when every input is NULL."""
    if isinstance(amount, str):
        return F.expr(_currency_sql(f"sum({_units_sql(amount)})"))
    return from_units(F.sum(units(amount)))


def negated_sum(amount: Column | str) -> Column:
    return from_units(-F.sum(units(amount)))


def inflow_sum(amount: str) -> Column:
    """Sum of the positive amounts, 0 when there is none."""
    part = f"CASE WHEN `{amount}` > 0 THEN {_units_sql(amount)} ELSE 0L END"
    return F.expr(_currency_sql(f"sum({part})"))


def outflow_sum(amount: str) -> Column:
    """Absolute sum of the negative amounts, 0 when there is none."""
    part = f"CASE WHEN `{amount}` < 0 THEN -{_units_sql(amount)} ELSE 0L END"
    return F.expr(_currency_sql(f"sum({part})"))


def money_text(amount: Column) -> Column:
    """Two-decimal text.  A double in a concat would print as 1.2E7."""
    return amount.cast("decimal(18,2)").cast("string")


def cents(amount: Column) -> Column:
    """Round half away from zero to two decimals without leaving doubles."""
    size = F.floor(F.abs(amount) * 100 + 0.5).cast("double") / 100.0
    return F.when(amount < 0, -size).otherwise(size) + 0.0
