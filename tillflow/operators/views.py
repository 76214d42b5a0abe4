"""Views and reports over the cash ledger and the balance table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.classify import CASH_ACCOUNT_TYPES, direction
from tillflow.functions.dates import DateLike, date_lit, week_start, weeks_before
from tillflow.functions.money import from_units, inflow_sum, money_sum, outflow_sum, units


def daily_cash_flow(ledger: DataFrame) -> DataFrame:
    """Actuals by day, section, category and subcategory."""
    keys = ["cash_date", "cash_flow_section", "cash_flow_category", "cash_flow_subcategory"]
    return (ledger.where(~F.col("is_forecast")).groupBy(*keys)
            .agg(inflow_sum("amount").alias("total_inflows"),
                 outflow_sum("amount").alias("total_outflows"),
                 money_sum("amount").alias("net_cash_flow"),
                 F.count(F.lit(1)).alias("transaction_count"))
            .orderBy(F.desc("cash_date"), *keys[1:]))


def weekly_cash_flow(ledger: DataFrame, as_of: DateLike, weeks: int = 13) -> DataFrame:
    """Actuals since ``weeks`` before ``as_of`` by Monday week; no upper end."""
    return (ledger.where(~F.col("is_forecast") & (F.col("cash_date") >= weeks_before(as_of, weeks)))
            .groupBy(week_start(F.col("cash_date")).alias("week_start"),
                     "cash_flow_section", "cash_flow_category")
            .agg(money_sum("amount").alias("net_cash_flow"),
                 F.count(F.lit(1)).alias("transaction_count"))
            .select("week_start", F.date_add("week_start", 6).alias("week_end"),
                    "cash_flow_section", "cash_flow_category",
                    "net_cash_flow", "transaction_count")
            .orderBy(F.desc("week_start"), "cash_flow_section", "cash_flow_category"))


def cash_position(balances: DataFrame) -> DataFrame:
    """One row: cash, credit drawn, credit left and liquidity on the last day.

    The latest day is a scalar subquery, so on a table partitioned by date the
    second scan reads only that day.
    """
    actual = balances.where(~F.col("is_forecast"))
    latest = actual.where(F.col("balance_date") == actual.agg(F.max("balance_date")).scalar())
    is_cash = F.col("account_type").isin(CASH_ACCOUNT_TYPES)
    is_loc = F.col("account_type") == "LOC"
    zero = F.lit(0).cast("bigint")
    return (latest.agg(
        F.sum(F.when(is_cash, units("ending_balance")).otherwise(zero)).alias("cash"),
        F.sum(F.when(is_loc, units(F.abs("ending_balance"))).otherwise(zero)).alias("drawn"),
        F.sum(F.when(is_loc, units("available_credit")).otherwise(zero)).alias("available"))
        .select(from_units(F.col("cash")).alias("total_cash"),
                from_units(F.col("drawn")).alias("total_loc_balance"),
                from_units(F.col("available")).alias("total_loc_available"),
                from_units(F.col("cash") + F.col("available")).alias("total_liquidity")))


def direction_summary(ledger: DataFrame) -> DataFrame:
    return (ledger.groupBy("cash_flow_section", direction(F.col("amount")).alias("direction"))
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money_sum("amount").alias("total_amount"))
            .orderBy("cash_flow_section", "direction"))


def daily_in_out(ledger: DataFrame, limit: int = 30) -> DataFrame:
    """Inflow, outflow and net of the latest days."""
    return (ledger.groupBy("cash_date")
            .agg(inflow_sum("amount").alias("inflows"),
                 outflow_sum("amount").alias("outflows"),
                 money_sum("amount").alias("net_cash_flow"))
            .orderBy(F.desc("cash_date")).limit(limit))


def top_revenue_days(ledger: DataFrame, limit: int = 20) -> DataFrame:
    return (ledger.where(F.col("amount") > 0)
            .groupBy("cash_date", "cash_flow_category")
            .agg(money_sum("amount").alias("revenue"))
            .orderBy(F.desc("revenue"), "cash_date", "cash_flow_category").limit(limit))


def recent_ledger(ledger: DataFrame, limit: int = 50) -> DataFrame:
    """Latest rows; equal dates are ordered by transaction id."""
    return (ledger.orderBy(F.desc("cash_date"), "transaction_id").limit(limit)
            .select("cash_date", "cash_flow_section", "cash_flow_category", "counterparty",
                    "amount", "description"))


def category_last_days(ledger: DataFrame, as_of: DateLike, days: int = 30) -> DataFrame:
    since = F.date_sub(date_lit(as_of), days)
    return (ledger.where((F.col("cash_date") >= since) & ~F.col("is_forecast"))
            .groupBy("cash_date", "cash_flow_category")
            .agg(money_sum("amount").alias("net_cash_flow"))
            .orderBy(F.desc("cash_date"), "cash_flow_category"))


def revenue_check(ledger: DataFrame, limit: int = 20) -> DataFrame:
    return (ledger.where((F.col("cash_flow_section") == "Operating")
                         & F.col("cash_flow_category").like("Revenue%"))
            .groupBy("cash_date", "cash_flow_category")
            .agg(F.count(F.lit(1)).alias("count"), money_sum("amount").alias("total_revenue"))
            .orderBy(F.desc("cash_date"), "cash_flow_category").limit(limit))


def vendor_outflow_check(ledger: DataFrame, limit: int = 20) -> DataFrame:
    return (ledger.where((F.col("cash_flow_section") == "Operating") & (F.col("amount") < 0))
            .groupBy("cash_date", "counterparty")
            .agg(F.count(F.lit(1)).alias("count"), money_sum("amount").alias("total_payments"))
            .orderBy(F.desc("cash_date"), "counterparty").limit(limit))


def latest_forecast(forecast: DataFrame, scenario: str = "base") -> DataFrame:
    """Rows of the greatest forecast id in one scenario, by week."""
    newest = forecast.agg(F.max("forecast_id")).scalar()
    return (forecast.where((F.col("forecast_id") == newest) & (F.col("scenario_id") == scenario))
            .select(F.col("period_date").alias("week_ending"), "week_number",
                    "operating_cash_flow", "ending_cash", "total_liquidity", "weeks_of_runway")
            .orderBy("week_number"))


def account_limits(accounts: DataFrame) -> DataFrame:
    """Accounts with their limit, shown for credit lines only."""
    limit = F.when(F.col("is_credit_line"), F.col("credit_limit"))
    return (accounts.select("account_name", "account_type", "institution_name",
                            limit.alias("limit"))
            .orderBy("account_type", "account_name"))


def active_recurring_by_size(recurring: DataFrame) -> DataFrame:
    return (recurring.where("is_active")
            .select("transaction_name", "amount", "frequency", "day_of_month", "recurring_id")
            .orderBy(F.abs("amount").desc(), "recurring_id").drop("recurring_id"))


def terms_listing(terms: DataFrame) -> DataFrame:
    return terms.select("term_name", "cycle_type", "lag_days").orderBy("term_name")


def scenario_listing(scenarios: DataFrame) -> DataFrame:
    return (scenarios.orderBy("scenario_id")
            .select("scenario_name", "scenario_type", "revenue_growth_rate"))
