"""Registered queries against their SQL on the smallest test folder.

One query per operator family keeps the run short; ``check.py`` compares all.
"""

import pytest

import check
from conftest import FOLDER
from tillflow.plans import registry

NAMES = [
    "table_scan", "sql_query", "sql_template", "read_refunds", "read_invoices", "coa_csv_scan",
    "payout_csv_scan", "loan_table", "revenue_by_channel", "refunds_by_platform",
    "cogs_and_fees", "vendor_payments", "purchase_commitments", "consolidated_cash_flow",
    "settle_deposits", "deposits_to_ledger", "refunds_to_ledger", "invoices_to_ledger",
    "invoices_preview", "v_daily_cash_flow", "v_weekly_cash_flow", "v_cash_position",
    "recent_ledger", "replace_scenario", "insert_rows_ignore_duplicates", "loan_status",
    "schedule_revolver", "schedule_totals", "weekly_forecast", "cash_position_runway",
    "cash_forecast_rollup", "weekly_balance", "risk_flags", "scenario_comparison",
    "apply_payment_timing", "map_accounts", "gl_to_ledger", "daily_balances", "budget_variance",
    "payout_settlement", "seasonal_revenue",
]


@pytest.fixture(scope="module")
def connection():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(name, spark, connection):
    query = registry.load()[name]
    assert check.compare(query.run, query.oracle, spark, connection, FOLDER) == ""


def test_every_query_has_an_oracle():
    assert [n for n, q in registry.load().items() if not q.oracle] == []
