"""Text sources: account-list CSV, payout-report CSV and loan config files.

Each parser takes a DataFrame with one text line per row, as ``spark.read.text``
gives it, so the work is spread over the input splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column order of the account list.
ACCOUNT_COLUMNS = ["account_number", "full_name", "account_type", "detail_type",
                   "description", "currency"]
ACCOUNT_HEADER = "Account #,"

# Column order of the payout report.
PAYOUT_COLUMNS = ["transaction_date", "type", "order", "card_brand", "card_source",
                  "payout_status", "payout_date", "payout_id", "available_on", "amount", "fee",
                  "net", "checkout", "payment_method_name", "presentment_amount",
                  "presentment_currency", "currency"]
PAYOUT_HEADER = "Transaction Date,"
PAYOUT_TIME = "yyyy-MM-dd HH:mm:ss Z"

LOAN_SCHEMA = {
    "loan_id": "string", "loan_name": "string", "lender": "string", "loan_type": "string",
    "original_amount": "double", "current_balance": "double", "annual_rate": "double",
    "payment_day": "int", "start_date": "date", "maturity_date": "date",
    "structure_choice": "string", "io_months": "int", "amort_months": "int",
    "fixed_payment": "double", "balloon_amount": "double",
}


def _csv(lines: DataFrame, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("value", schema).alias("r")).select("r.*")


def parse_account_list(lines: DataFrame) -> DataFrame:
    """Account rows of the export, without its title, header and trailer lines.

    Only account rows name a type in the third column; title, TOTAL and
    timestamp lines leave it empty.
    """
    rows = _csv(lines.where(F.col("value").isNotNull() & (F.trim("value") != "")
                            & ~F.col("value").startswith(ACCOUNT_HEADER)), ACCOUNT_COLUMNS)
    return rows.where(F.col("full_name").isNotNull() & F.col("account_type").isNotNull())


def read_account_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_account_list(spark.read.text(path))


def parse_payout_report(lines: DataFrame) -> DataFrame:
    """Typed payout lines; times with an offset become instants."""
    rows = _csv(lines.where(~F.col("value").startswith(PAYOUT_HEADER)
                            & (F.trim("value") != "")), PAYOUT_COLUMNS)
    money = lambda c: F.col(c).cast("double").alias(c)
    return rows.select(
        F.to_timestamp("transaction_date", PAYOUT_TIME).alias("transaction_time"),
        "type", "order", "card_brand", "card_source", "payout_status",
        F.to_date("payout_date").alias("payout_date"), "payout_id",
        F.to_date("available_on").alias("available_on"), money("amount"), money("fee"),
        money("net"), "checkout", "payment_method_name", money("presentment_amount"),
        "presentment_currency", "currency")


def read_payout_report(spark: SparkSession, path: str) -> DataFrame:
    return parse_payout_report(spark.read.text(path))


PHASE_MONTHS = ["io_months", "amort_months"]
# Without these no payment has a date or an amount.
REQUIRED_FIELDS = ["loan_id", "current_balance", "annual_rate", "payment_day", "start_date"]


def _config_value(line: Column) -> Column:
    """The value of ``key: value  # note``; quotes dropped, null and ~ empty."""
    quoted = F.regexp_extract(line, r'^\s*\w+:\s*"([^"]*)"', 1)
    bare = F.trim(F.regexp_extract(line, r'^\s*\w+:\s*([^"#]*)', 1))
    value = F.when(line.rlike(r'^\s*\w+:\s*"'), quoted).otherwise(bare)
    return F.when(~value.isin("null", "~", ""), value)


def parse_loan_configs(lines: DataFrame) -> DataFrame:
    """One loan row per ``file`` from lines (file, value) of flat config text.

    An absent phase has 0 months; a config without one of ``REQUIRED_FIELDS`` raises.
    Text values are aggregated by sorting.  Lines are dealt by file first, so that a task
    sorts one partition of that shuffle and not all lines it has read.
    """
    keyed = lines.select("file", F.regexp_extract("value", r"^(\w+):", 1).alias("key"),
                         _config_value(F.col("value")).alias("setting"))
    def field(name: str, kind: str) -> Column:
        value = F.max(F.when(F.col("key") == name, F.col("setting"))).cast(kind)
        if name in PHASE_MONTHS:
            value = F.coalesce(value, F.lit(0).cast(kind))
        elif name in REQUIRED_FIELDS:
            missing = F.concat(F.lit(f"loan config without {name}: "), F.col("file"))
            value = F.coalesce(value, F.raise_error(missing).cast(kind))
        return value.alias(name)

    return (keyed.where(F.col("key").isin(list(LOAN_SCHEMA))).repartition("file")
            .groupBy("file").agg(*[field(n, k) for n, k in LOAN_SCHEMA.items()]).drop("file"))


def read_loan_configs(spark: SparkSession, path: str) -> DataFrame:
    """All loan config files under ``path`` as one loan table."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_loan_configs(lines)
