"""Seed rows of the rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas

# The default payment terms
# (id, name, category, cycle, settlement period, settlement lag, description).
PAYMENT_TERMS = [
    ("amazon_settlement", "Amazon Settlement", "Revenue", "Bi-Weekly", 14, 2,
     "Amazon bi-weekly settlement cycle"),
    ("shopify_payout", "Shopify Payout", "Revenue", "Daily", None, 2,
     "Shopify daily payout (weekdays)"),
    ("net_30", "Net 30", "Expense", "Invoice-Based", None, 30,
     "Payment due 30 days after invoice"),
    ("net_15", "Net 15", "Expense", "Invoice-Based", None, 15,
     "Payment due 15 days after invoice"),
    ("net_60", "Net 60", "Expense", "Invoice-Based", None, 60,
     "Payment due 60 days after invoice"),
    ("credit_card", "Credit Card", "Expense", "Monthly", None, 30,
     "Credit card payment ~30 days after charge"),
    ("sba_loan_monthly", "SBA Loan Monthly", "Debt Service", "Monthly", None, 0,
     "SBA loan monthly payment on day 30"),
]

# The default scenarios
# (id, name, type, description, revenue growth, expense inflation).
SCENARIOS = [
    ("base", "Base Case", "Base", "Conservative baseline forecast", 0.0, 0.03),
    ("best", "Best Case", "Best", "Optimistic scenario", 0.20, 0.03),
    ("worst", "Worst Case", "Worst", "Pessimistic scenario", -0.15, 0.05),
]

# Synthetic accounts: one per account type
# (id, name, type, institution, credit line, limit, rate).
BANK_ACCOUNTS = [
    ("operating_checking", "Operating Checking", "Checking", "Example Bank", False, None, None),
    ("reserve_savings", "Reserve Savings", "Savings", "Example Bank", False, None, None),
    ("money_market", "Money Market", "Money Market", "Example Bank", False, None, None),
    ("credit_line", "Revolving Credit Line", "LOC", "Example Bank", True, 500000.0, 0.1),
    ("company_card", "Company Card", "Credit Card", "Example Card", True, 25000.0, 0.2),
]

# Synthetic recurring items (id, name, category, amount, day, start).
RECURRING = [
    ("rec_loan_interest", "Loan interest", "Financing - Debt Service", -2000.0, 30, "2024-01-30"),
    ("rec_software", "Software subscription", "OpEx - Software", -250.0, 1, "2024-01-01"),
]


def seed_payment_terms(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        PAYMENT_TERMS, "term_id string, term_name string, term_category string, "
        "cycle_type string, settlement_period_days bigint, settlement_lag_days bigint, "
        "description string")
    return schemas.fill_missing(rows, schemas.PAYMENT_TERMS)


def seed_scenarios(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        SCENARIOS, "scenario_id string, scenario_name string, scenario_type string, "
        "description string, revenue_growth_rate double, expense_inflation_rate double")
    return schemas.fill_missing(rows, schemas.SCENARIOS)


def seed_bank_accounts(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        BANK_ACCOUNTS, "account_id string, account_name string, account_type string, "
        "institution_name string, is_credit_line boolean, credit_limit double, "
        "interest_rate double")
    return schemas.fill_missing(rows, schemas.BANK_ACCOUNTS)


def seed_recurring(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        RECURRING, "recurring_id string, transaction_name string, cash_flow_category string, "
        "amount double, day_of_month bigint, start_date string")
    return schemas.fill_missing(
        rows.withColumn("start_date", F.to_date("start_date"))
            .withColumn("frequency", F.lit("Monthly")), schemas.RECURRING_TRANSACTIONS)
