"""Steps that make many rows of one: what they carry and how they are dealt."""

import re

from tillflow.operators import accounts, debt
from tillflow.plans import registry
from tillflow.sources import files

from conftest import FOLDER


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_made_after_the_joins(spark):
    """Joins sort one row a movement, not one a day."""
    for name in ("scenario_balances", "daily_balances"):
        plan = plan_of(registry.load()[name].run(spark, FOLDER))
        days = plan.index("Generate explode(sequence(balance_date")
        assert "Join" not in plan[:days] and "Join" in plan[days:]


def test_repeated_accounts_still_repeat_their_days(frame):
    ledger = frame("bank_account_id string, cash_date date, amount double, is_forecast boolean, scenario_id string",
                   ("a", "2026-01-01", 10.0, False, None), ("a", "2026-01-04", -3.0, True, "base"),
                   (None, "2026-01-02", 1.0, False, None), ("a", "2026-01-05", 2.0, True, None))
    known = frame("account_id string, account_type string, opening_balance double, credit_limit double",
                  ("a", "LOC", 100.0, 500.0), ("a", "Checking", 7.0, None), (None, "LOC", 1.0, 1.0))
    rows = accounts.scenario_balances(ledger, known).collect()
    found = sorted((str(r["scenario_id"]), str(r["bank_account_id"]), str(r["balance_date"])[-2:], r["ending_balance"])
                   for r in rows)
    assert found == sorted(
        [(s, "a", d, opening + 10.0 + move) for s, moves in (("base", {"03": 0.0, "04": -3.0, "05": -3.0}),
                                                           ("None", {"03": 0.0, "04": 0.0, "05": 2.0}))
         for d, move in moves.items() for opening in (100.0, 7.0)]
        + [(s, "None", d, 0.0) for s in ("base", "None") for d in ("03", "04", "05")])


def test_config_lines_are_dealt_before_they_are_sorted(spark):
    lines = spark.createDataFrame([("f", "loan_id: x")], "file string, value string")
    plan = plan_of(files.parse_loan_configs(lines))
    assert "SortAggregate" not in plan[plan.rindex("Exchange hashpartitioning(file"):]


def test_pieces_of_a_credit_line_are_dealt_by_month(spark):
    plan = plan_of(registry.load()["schedule_variable_revolver"].run(spark, FOLDER))
    assert re.search(r"Exchange hashpartitioning\(loan_id#\d+, month#\d+", plan)


def test_loans_are_dealt_before_their_payments(tables):
    plan = plan_of(debt.loan_schedule(tables.loans, "1998-07-01"))
    branches = re.split(r"Generate explode", plan)[1:]
    assert len(branches) == 4
    assert all("Exchange hashpartitioning(loan_id" in b for b in branches)
