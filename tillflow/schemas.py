"""Schemas of the 13 warehouse tables, their defaults and physical layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DoubleType, LongType,
                               StringType, StructField, StructType, TimestampType)

# Short type names of the table declarations below.
TYPES: dict[str, DataType] = {
    "text": StringType(), "int": LongType(), "money": DoubleType(), "flag": BooleanType(),
    "date": DateType(), "time": TimestampType(), "texts": ArrayType(StringType()),
}


def table(declaration: str) -> StructType:
    """``name type`` per line; a trailing ``!`` marks NOT NULL."""
    fields = []
    for line in declaration.split("\n"):
        if line.strip():
            name, kind = line.split()
            fields.append(StructField(name, TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return StructType(fields)


BANK_ACCOUNTS = table("""
    account_id text!
    account_name text!
    account_number text
    account_type text!
    institution_name text!
    institution_routing text
    is_credit_line flag
    credit_limit money
    interest_rate money
    qb_account_name text
    qb_account_number text
    is_active flag
    opened_date date
    closed_date date
    notes text
    created_at time
    updated_at time
""")

CHART_OF_ACCOUNTS = table("""
    account_id text!
    account_number text
    account_name text!
    account_type text!
    account_subtype text
    parent_account_id text
    account_level int
    cash_flow_section text
    cash_flow_category text
    cash_flow_subcategory text
    is_cash_account flag
    default_payment_timing text
    is_active flag
    description text
    notes text
    qb_account_id text
    qb_fully_qualified_name text
    created_at time
    updated_at time
""")

PAYMENT_TERMS = table("""
    term_id text!
    term_name text!
    term_category text
    cycle_type text
    lag_days int
    payout_days texts
    payout_day_of_month int
    settlement_period_days int
    settlement_lag_days int
    weekend_handling text
    description text
    example text
    is_active flag
    created_at time
    updated_at time
""")

LEDGER = table("""
    transaction_id text!
    transaction_date date!
    cash_date date!
    value_date date
    source_system text!
    source_id text
    source_table text
    bank_account_id text
    bank_account_name text
    cash_flow_section text!
    cash_flow_category text!
    cash_flow_subcategory text
    amount money!
    currency text
    counterparty text
    counterparty_type text
    description text
    notes text
    is_forecast flag
    is_recurring flag
    recurring_id text
    scenario_id text
    tags texts
    created_at time
    updated_at time
    created_by text
""")

CASH_BALANCES = table("""
    balance_date date!
    bank_account_id text!
    bank_account_name text
    account_type text
    beginning_balance money!
    ending_balance money!
    total_inflows money
    total_outflows money
    net_change money
    credit_limit money
    available_credit money
    is_forecast flag
    scenario_id text
    created_at time
    updated_at time
""")

DEBT_SCHEDULE = table("""
    schedule_id text!
    loan_id text!
    loan_name text!
    lender text!
    payment_date date!
    payment_number int
    payment_amount money!
    principal_amount money!
    interest_amount money!
    fees_amount money
    beginning_principal money!
    ending_principal money!
    interest_rate money!
    days_in_period int
    is_paid flag
    actual_payment_date date
    actual_payment_amount money
    payment_type text
    is_forecast flag
    scenario_id text
    created_at time
    updated_at time
""")

CASH_FORECAST = table("""
    forecast_id text!
    forecast_date date!
    period_date date!
    scenario_id text!
    week_number int
    is_actual flag
    operating_inflows money
    operating_outflows money
    operating_cash_flow money
    investing_outflows money
    financing_inflows money
    financing_outflows money
    net_cash_flow money
    beginning_cash money!
    ending_cash money!
    loc_balance money
    loc_available money
    total_liquidity money
    avg_weekly_burn money
    weeks_of_runway int
    forecast_method text
    confidence_level text
    notes text
    created_at time
    created_by text
""")

GL_TRANSACTIONS = table("""
    entry_id text!
    transaction_date date!
    posting_date date
    account_number text
    account_name text!
    account_type text
    debit_amount money
    credit_amount money
    amount money
    transaction_type text
    description text
    memo text
    reference_number text
    customer text
    vendor text
    class text
    source_document text
    is_reconciled flag
    reconcile_date date
    qb_transaction_id text
    imported_at time
""")

RECURRING_TRANSACTIONS = table("""
    recurring_id text!
    transaction_name text!
    cash_flow_category text!
    amount money!
    currency text
    frequency text!
    recurrence_interval int
    day_of_week int
    day_of_month int
    month_of_year int
    start_date date!
    end_date date
    counterparty text
    bank_account_id text
    description text
    notes text
    is_active flag
    created_at time
    updated_at time
""")

CAPEX_PLAN = table("""
    capex_id text!
    project_name text!
    category text!
    description text
    estimated_cost money!
    actual_cost money
    variance money
    planned_date date!
    actual_date date
    payment_terms text
    deposit_amount money
    deposit_date date
    final_payment_amount money
    final_payment_date date
    status text!
    approved_by text
    approved_date date
    vendor text
    po_number text
    notes text
    created_at time
    updated_at time
""")

BUDGET = table("""
    budget_id text!
    fiscal_year int!
    period_type text!
    period_start_date date!
    cash_flow_section text!
    cash_flow_category text!
    cash_flow_subcategory text
    budget_amount money!
    version int
    is_active flag
    notes text
    created_at time
    created_by text
""")

SCENARIOS = table("""
    scenario_id text!
    scenario_name text!
    scenario_type text!
    description text
    revenue_growth_rate money
    expense_inflation_rate money
    custom_assumptions text
    is_active flag
    created_at time
    created_by text
""")

FORECAST_ASSUMPTIONS = table("""
    assumption_id text!
    scenario_id text!
    forecast_date date!
    assumption_category text!
    assumption_name text!
    assumption_value money
    assumption_value_text text
    value_type text
    description text
    rationale text
    data_source text
    confidence_level text
    created_at time
    created_by text
""")


@dataclass(frozen=True)
class Layout:
    """Where a table's rows go.

    ``date`` gives month partitions, ``bucket`` a fixed number of hash
    partitions of that column; ``sort`` orders the rows inside a file.
    """

    schema: StructType
    date: str | None = None
    sort: tuple[str, ...] = ()
    bucket: str | None = None


TABLES: dict[str, Layout] = {
    "bank_accounts": Layout(BANK_ACCOUNTS),
    "chart_of_accounts": Layout(CHART_OF_ACCOUNTS),
    "payment_terms": Layout(PAYMENT_TERMS),
    "cash_transactions": Layout(LEDGER, "cash_date", ("bank_account_id", "cash_flow_category")),
    "cash_balances": Layout(CASH_BALANCES, "balance_date", ("bank_account_id",)),
    # by loan, not by month: loans are replaced and deleted one at a time
    "debt_schedule": Layout(DEBT_SCHEDULE, None, ("loan_id", "payment_date"), "loan_id"),
    "cash_forecast": Layout(CASH_FORECAST, "forecast_date", ("scenario_id", "period_date")),
    "gl_transactions": Layout(GL_TRANSACTIONS, "transaction_date", ("account_name",)),
    "recurring_transactions": Layout(RECURRING_TRANSACTIONS),
    "capex_plan": Layout(CAPEX_PLAN, "planned_date"),
    "budget": Layout(BUDGET, "period_start_date", ("fiscal_year", "cash_flow_category")),
    "scenarios": Layout(SCENARIOS),
    "forecast_assumptions": Layout(FORECAST_ASSUMPTIONS, "forecast_date",
                                   ("scenario_id", "assumption_category")),
}

VIEWS = ("v_daily_cash_flow", "v_weekly_cash_flow", "v_cash_position")

# Column defaults of the table declarations, by column name.
DEFAULTS: dict[str, object] = {
    "is_credit_line": False, "is_forecast": False, "is_recurring": False, "is_paid": False,
    "is_reconciled": False, "is_cash_account": True, "is_active": True, "currency": "USD",
    "recurrence_interval": 1, "version": 1, "fees_amount": 0.0, "total_inflows": 0.0,
    "total_outflows": 0.0, "debit_amount": 0.0, "credit_amount": 0.0,
    "operating_inflows": 0.0, "operating_outflows": 0.0, "investing_outflows": 0.0,
    "financing_inflows": 0.0, "financing_outflows": 0.0, "created_by": "system",
}
NOW_COLUMNS = ("created_at", "updated_at", "imported_at")
# These declare created_by without a default.
NO_CREATOR_DEFAULT = [BUDGET, SCENARIOS, FORECAST_ASSUMPTIONS]


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _missing(field: StructField, schema: StructType) -> str:
    if field.name in NOW_COLUMNS:
        return "current_timestamp()"
    if field.name == "created_by" and schema in NO_CREATOR_DEFAULT:
        return "NULL"
    return _literal(DEFAULTS.get(field.name))


def fill_missing(rows: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order; absent ones get their default.

    A column that a NOT NULL declaration demands must be in ``rows``.
    """
    have = set(rows.columns)
    absent = [f.name for f in schema if not f.nullable and f.name not in have]
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    return rows.selectExpr(*[
        f"CAST({f.name if f.name in have else _missing(f, schema)} "
        f"AS {f.dataType.simpleString()}) AS {f.name}" for f in schema])
