"""Labels of the cash-flow statement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The named sales channels.
CHANNELS = ["Amazon", "Shopify", "TikTok"]

# Account types that count as cash.
CASH_ACCOUNT_TYPES = ["Checking", "Savings", "Money Market"]


def channel_label(platform: Column, prefix: str) -> Column:
    """``prefix`` + channel for the named channels, ``prefix`` + Other else."""
    return F.when(platform.isin(CHANNELS), F.concat(F.lit(prefix), platform)) \
            .otherwise(F.lit(prefix + "Other"))


def revenue_category(platform: Column) -> Column:
    """Ledger category: every platform keeps its own name."""
    return F.concat(F.lit("Revenue - "), platform)


def direction(amount: Column) -> Column:
    return F.when(amount > 0, "Inflow").otherwise("Outflow")


def financing_if_debt(category: Column) -> Column:
    is_debt = category.contains("Debt") | category.contains("Loan")
    return F.when(is_debt, "Financing").otherwise("Operating")
