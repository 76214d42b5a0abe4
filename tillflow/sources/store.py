"""The whole warehouse under one root folder: tables, seeds and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.functions.dates import DateLike
from tillflow.operators import views
from tillflow.schemas import TABLES
from tillflow.sources import seeds, sinks

LEDGER_TABLE = "cash_transactions"


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the folders of the 13 tables; existing tables stay as they are."""
    for name, layout in TABLES.items():
        # appending no rows makes the folder and changes nothing else
        spark.createDataFrame([], layout.schema).write.mode("append").parquet(f"{root}/{name}")


def seed_tables(spark: SparkSession, root: str) -> None:
    """Insert the seed rows that are not there yet."""
    rows = {"payment_terms": (seeds.seed_payment_terms, "term_id"),
            "scenarios": (seeds.seed_scenarios, "scenario_id"),
            "bank_accounts": (seeds.seed_bank_accounts, "account_id"),
            "recurring_transactions": (seeds.seed_recurring, "recurring_id")}
    for name, (make, key) in rows.items():
        sinks.insert_ignoring_duplicates(make(spark), name, f"{root}/{name}", [key])


def open_tables(spark: SparkSession, root: str, as_of: DateLike) -> dict[str, DataFrame]:
    """The tables and the three views, lazily, by name."""
    tables = {name: sinks.read_table(spark, name, f"{root}/{name}")
              for name in TABLES if name != LEDGER_TABLE}
    ledger = sinks.read_ledger(spark, f"{root}/{LEDGER_TABLE}")
    tables[LEDGER_TABLE] = ledger
    tables["v_daily_cash_flow"] = views.daily_cash_flow(ledger)
    tables["v_weekly_cash_flow"] = views.weekly_cash_flow(ledger, as_of)
    tables["v_cash_position"] = views.cash_position(tables["cash_balances"])
    return tables


def register_views(spark: SparkSession, root: str, as_of: DateLike) -> None:
    """Make every table and view known to ``spark.sql`` by its name."""
    for name, rows in open_tables(spark, root, as_of).items():
        rows.createOrReplaceTempView(name)
