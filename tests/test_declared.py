"""Timing rules, account mapping, budgets and payouts."""

import pytest

from tillflow.operators import accounts, timing

RULES = ("term_id string, lag_days bigint, settlement_period_days bigint, "
         "settlement_lag_days bigint, weekend_handling string")


def rules(frame):
    return frame(RULES, ("settle", None, 14, 2, "No Adjustment"),
                 ("payout", 2, None, None, "Next Business Day"),
                 ("early", 2, None, None, "Previous Business Day"),
                 ("now", 0, None, None, "No Adjustment"), ("unknown", None, None, None, None))


def cash_dates(frame, rule_rows, **options):
    rows = frame("term_id string, transaction_date date", *rule_rows)
    out = timing.apply_payment_timing(rows, rules(frame), **options)
    found = {(r["term_id"], str(r["transaction_date"])): str(r["cash_date"]) for r in out.collect()}
    return [found[key] for key in rule_rows]


def test_settlement_period_then_lag(frame):
    found = cash_dates(frame, [("settle", "2026-02-01"), ("settle", "2026-02-14"),
                               ("settle", "2026-02-15")], anchor="2026-02-01")
    assert found == ["2026-02-16", "2026-02-16", "2026-03-02"]


def test_lags_and_weekends(frame):
    # 2026-02-26 is a Thursday
    found = cash_dates(frame, [("payout", "2026-02-26"), ("early", "2026-02-26"),
                               ("now", "2026-02-28"), ("unknown", "2026-02-28"),
                               ("no such rule", "2026-02-28"), ("payout", "2026-02-24")])
    assert found == ["2026-03-02", "2026-02-27", "2026-02-28", "None", "2026-02-28",
                     "2026-02-26"]


def test_holidays_push_to_the_next_business_day(frame):
    holidays = frame("holiday date", ("2026-03-02",))
    found = cash_dates(frame, [("payout", "2026-02-26"), ("now", "2026-03-02")],
                       holidays=holidays)
    assert found == ["2026-03-03", "2026-03-02"]


def test_holidays_have_no_span(frame):
    # Thursday and Friday off, then a weekend, then Monday off
    holidays = frame("holiday date", ("2026-01-08",), ("2026-01-09",), ("2026-01-12",), ("2026-01-10",),
                     ("1999-12-31",), ("2050-06-01",))
    found = cash_dates(frame, [("payout", "2026-01-06"), ("payout", "1999-12-29"), ("payout", "2050-05-30")],
                       holidays=holidays)
    assert found == ["2026-01-13", "2000-01-03", "2050-06-02"]


def test_seeded_terms_pay_after_their_lag(spark, frame):
    from tillflow.sources import seeds

    names = ["net_15", "net_30", "net_60", "credit_card", "shopify_payout"]
    rows = frame("term_id string, transaction_date date", *[(n, "2026-01-06") for n in names])
    out = timing.apply_payment_timing(rows, seeds.seed_payment_terms(spark)).collect()
    assert {r["term_id"]: (r["cash_date"] - r["transaction_date"]).days for r in out} == {
        "net_15": 15, "net_30": 30, "net_60": 60, "credit_card": 30, "shopify_payout": 2}


def test_calendar_rules_and_own_anchors(spark, frame):
    from tillflow.sources.rules import timing_rules

    config = {"revenue_timing": {
        "weekly": {"payout_lag_days": 1, "payout_days": ["Friday"]},
        "open": {"payout_lag_days": None}},
        "expense_timing": {"payroll": {"payment_days": [15, 30]}, "monthly": {"payment_day": 1},
                           "fees": {"payment_timing": "with_payout"}, "cash": {"payment_timing": "immediate"}}}
    table = timing_rules(spark, config)
    rows = frame("term_id string, transaction_date date", ("weekly", "2026-02-06"), ("open", "2026-02-06"),
                 ("payroll", "2026-02-16"), ("payroll", "2026-02-15"), ("monthly", "2026-02-02"),
                 ("fees", "2026-02-02"), ("cash", "2026-02-02"))
    out = timing.apply_payment_timing(rows, table).collect()
    found = {(r["term_id"], str(r["transaction_date"])): str(r["cash_date"]) for r in out}
    assert found == {("weekly", "2026-02-06"): "2026-02-13", ("open", "2026-02-06"): "None",
                     ("payroll", "2026-02-16"): "2026-02-28", ("payroll", "2026-02-15"): "2026-02-15",
                     ("monthly", "2026-02-02"): "2026-03-01", ("fees", "2026-02-02"): "None",
                     ("cash", "2026-02-02"): "2026-02-02"}
    anchored = frame(RULES + ", settlement_anchor date", ("a", None, 14, 2, None, "2026-02-01"))
    row = frame("term_id string, transaction_date date", ("a", "2026-02-10"))
    assert str(timing.apply_payment_timing(row, anchored).first()["cash_date"]) == "2026-02-16"


def test_seasons(frame):
    rows = frame("month date, revenue double", ("2026-01-01", 100.0), ("2026-06-01", 100.0),
                 ("2026-12-01", 100.0))
    out = timing.seasonal_revenue(rows, "month", "revenue").collect()
    assert [r["seasonal_amount"] for r in out] == [60.0, 100.0, 250.0]


MAP = ("section string, account string, account_number string, category string, "
       "subcategory string, cash_timing string")


def category_map(frame):
    return frame(MAP, ("operating_inflows", "Web Sales", "4001", "Revenue - Web", "Ecommerce", "now"),
                 ("financing_inflows", "Bank Loan", "Bank Loan", "Financing - Debt", "Draws", "now"),
                 ("financing_outflows", "Bank Loan", "Bank Loan", "Debt Service", "Payments", "monthly"),
                 ("cogs", "Freight", None, "COGS - Shipping", "Out", "net_15"),
                 ("non_cash_items", "Depreciation", "7920", None, None, None))


def test_accounts_map_by_number_then_leaf_without_fan_out(frame):
    coa = frame("account_number string, full_name string, account_type string",
                ("4001", "Income:Renamed", "Income"), (None, "Costs:Inbound:Freight", "Expenses"),
                (None, "Bank Loan", "Liability"), ("7920", "Depreciation", "Expenses"),
                ("9999", "Other", "Expenses"))
    found = {r["full_name"]: r for r in accounts.map_accounts(coa, category_map(frame)).collect()}
    assert len(found) == 5
    assert found["Income:Renamed"]["cash_flow_category"] == "Revenue - Web"
    freight = found["Costs:Inbound:Freight"]
    assert (freight["account_level"], freight["parent_name"], freight["account_name"]) == \
        (3, "Costs:Inbound", "Freight")
    assert freight["cash_flow_section"] == "Operating"
    both = found["Bank Loan"]
    assert (both["cash_flow_category"], both["inflow_category"]) == ("Debt Service", "Financing - Debt")
    assert found["Depreciation"]["is_cash_account"] is False
    assert found["Other"]["cash_flow_section"] is None


def test_gl_rows_turn_sign_and_leave_out_non_cash(frame):
    gl = frame("entry_id string, transaction_date date, account_number string, "
               "account_name string, amount double, vendor string, transaction_type string",
               ("1", "2026-01-01", "4001", "x", -500.0, None, "Sale"),
               ("2", "2026-01-01", "Bank Loan", "Bank Loan", -900.0, "B", "Draw"),
               ("3", "2026-01-01", "Bank Loan", "Bank Loan", 100.0, "B", "Payment"),
               ("4", "2026-01-01", "7920", "Depreciation", 70.0, None, "Journal"),
               ("5", "2026-01-01", None, "Mystery", 30.0, None, "Journal"))
    found = {r["source_id"]: (r["cash_flow_category"], r["amount"])
             for r in accounts.gl_to_ledger(gl, category_map(frame)).collect()}
    assert found == {"1": ("Revenue - Web", 500.0), "2": ("Financing - Debt", 900.0),
                     "3": ("Debt Service", -100.0), "5": ("Unclassified", -30.0)}


def test_rules_by_full_name_and_first_of_the_configuration(spark, frame):
    from tillflow.sources.rules import category_map as configured

    rules = configured(spark, {
        "operating_outflows": [{"account": "Ads", "category": "OpEx - Ads"},
                               {"account": "Office:Rent", "category": "Rent"}],
        "cogs": [{"account": "Ads", "category": "COGS - Ads"}],
        "clearing_accounts": [{"account": "Clearing:Clearing - A", "account_number": "1101"}]})
    conflicts = accounts.rule_conflicts(rules).collect()
    assert [(r["leaf"], r["used"]["category"], [u["category"] for u in r["unused"]]) for r in conflicts] == [
        ("Ads", "OpEx - Ads", ["COGS - Ads"])]
    gl = frame("entry_id string, transaction_date date, account_number string, account_name string, "
               "amount double, vendor string, transaction_type string",
               ("1", "2026-01-01", None, "Office:Rent", 10.0, None, "x"),
               ("2", "2026-01-01", None, "Marketing:Ads", 20.0, None, "x"),
               ("3", "2026-01-01", "1101", "Clearing:Clearing - A", 100.0, None, "x"),
               ("4", "2026-01-01", None, "Clearing:Clearing - A", 100.0, None, "x"))
    found = {r["source_id"]: r["cash_flow_category"] for r in accounts.gl_to_ledger(gl, rules).collect()}
    assert found == {"1": "Rent", "2": "OpEx - Ads"}


def test_daily_balances_chain_per_account(frame):
    ledger = frame("bank_account_id string, cash_date date, amount double, is_forecast boolean",
                   ("a", "2026-01-01", 10.0, False), ("a", "2026-01-01", -4.0, False),
                   ("a", "2026-01-03", -1.0, False), ("b", "2026-01-01", 5.0, False),
                   ("a", "2026-01-02", 99.0, True))
    known = frame("account_id string, account_type string, opening_balance double, "
                  "credit_limit double", ("a", "LOC", 100.0, 500.0))
    rows = sorted(accounts.daily_balances(ledger, known).collect(),
                  key=lambda r: (r["bank_account_id"], r["balance_date"]))
    assert [(r["beginning_balance"], r["ending_balance"]) for r in rows] == \
        [(100.0, 106.0), (106.0, 106.0), (106.0, 105.0), (0.0, 5.0), (5.0, 5.0), (5.0, 5.0)]
    assert [r["available_credit"] for r in rows] == [394.0, 394.0, 395.0, None, None, None]
    assert [r["total_inflows"] for r in rows] == [10.0, 0.0, 0.0, 5.0, 0.0, 0.0]


def test_budget_rows_without_a_partner_stay(frame):
    budget = frame("period_start_date date, cash_flow_section string, cash_flow_category string, "
                   "budget_amount double, is_active boolean",
                   ("2026-01-01", "Operating", "A", 100.0, True),
                   ("2026-02-01", "Operating", "A", 100.0, True),
                   ("2026-01-01", "Operating", "A", 900.0, False))
    ledger = frame("cash_date date, cash_flow_section string, cash_flow_category string, "
                   "amount double, is_forecast boolean", ("2026-01-15", "Operating", "A", 80.0, False),
                   ("2026-01-15", "Operating", "B", 5.0, False))
    found = {(str(r["period_start_date"]), r["cash_flow_category"]):
             (r["variance_amount"], r["variance_pct"])
             for r in accounts.budget_variance(budget, ledger).collect()}
    assert found == {("2026-01-01", "A"): (-20.0, -20.0), ("2026-02-01", "A"): (-100.0, -100.0),
                     ("2026-01-01", "B"): (5.0, None)}


def test_budgets_of_all_types_and_their_latest_version(frame):
    budget = frame("period_type string, period_start_date date, cash_flow_section string, cash_flow_category string, "
                   "cash_flow_subcategory string, budget_amount double, version bigint, is_active boolean",
                   ("Monthly", "2026-02-01", "Operating", "A", "x", 100.0, 1, True),
                   ("Monthly", "2026-02-01", "Operating", "A", "x", 120.0, 2, True),
                   ("Monthly", "2026-02-01", "Operating", "A", "x", 900.0, 3, False),
                   ("Monthly", "2026-02-01", "Operating", "A", "y", 5.0, 1, True),
                   ("Quarterly", "2026-01-01", "Operating", "A", None, 400.0, 1, True),
                   ("Annual", "2026-01-01", "Operating", "A", None, 1000.0, None, True))
    ledger = frame("cash_date date, cash_flow_section string, cash_flow_category string, amount double, is_forecast boolean",
                   ("2026-01-15", "Operating", "A", 80.0, False), ("2026-02-15", "Operating", "A", 130.0, False),
                   ("2026-05-15", "Operating", "A", 10.0, False), ("2026-03-01", "Operating", "B", 7.0, False))
    found = {(r["period_type"], str(r["period_start_date"]), r["cash_flow_category"]):
             (r["budget_amount"], r["actual_amount"], r["version"])
             for r in accounts.budget_variance(budget, ledger).collect()}
    assert found[("Monthly", "2026-02-01", "A")] == (125.0, 130.0, 2)
    assert found[("Quarterly", "2026-01-01", "A")] == (400.0, 210.0, 1)
    assert found[("Quarterly", "2026-04-01", "A")] == (None, 10.0, None)
    assert found[("Annual", "2026-01-01", "A")] == (1000.0, 220.0, 1)
    assert found[("Annual", "2026-01-01", "B")] == (None, 7.0, None)
    # a budget without quarters shows none
    months = accounts.budget_variance(budget.where("period_type = 'Monthly'"), ledger)
    assert {r["period_type"] for r in months.collect()} == {"Monthly"}


BALANCE_ROWS = ("bank_account_id string, cash_date date, amount double, is_forecast boolean, scenario_id string",
                ("a", "2026-01-01", 10.0, False, None), ("a", "2026-01-04", -3.0, False, None),
                ("b", "2026-01-02", 5.0, False, None), ("b", "2026-01-09", 1.0, False, None),
                ("a", "2026-01-03", 50.0, True, "base"), ("a", "2026-01-11", -2.0, True, "base"),
                ("c", "2026-01-12", 4.0, True, "best"))
KNOWN = ("account_id string, account_type string, opening_balance double, credit_limit double", ("a", "LOC", 100.0, 500.0))


@pytest.mark.parametrize("since", ["2026-01-03", "2026-01-04", "2026-01-07", "2026-01-10"])
def test_updated_balances_equal_the_recompute(frame, since):
    from pyspark.sql import functions as F

    ledger, known = frame(*BALANCE_ROWS), frame(*KNOWN)
    whole = accounts.daily_balances(ledger, known)
    stored = accounts.daily_balances(ledger.where(F.col("cash_date") < since), known)
    again = accounts.updated_daily_balances(stored, ledger, known, since)
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.select(*again.columns).collect()))


def test_scenarios_go_on_from_the_last_closing(frame):
    rows = accounts.scenario_balances(frame(*BALANCE_ROWS), frame(*KNOWN)).collect()
    found = {(r["scenario_id"], r["bank_account_id"], str(r["balance_date"])[-2:]): r["ending_balance"] for r in rows}
    assert len(rows) == len(found) == 2 * 2 * 3 + 1  # a and b on 10 to 12 in both, c once
    assert found[("base", "a", "10")] == 107.0 and found[("base", "a", "12")] == 105.0
    assert found[("best", "a", "12")] == 107.0 and found[("best", "b", "12")] == 6.0
    assert found[("best", "c", "12")] == 4.0 and all(r["is_forecast"] for r in rows)
    early = accounts.scenario_balances(frame(*BALANCE_ROWS), frame(*KNOWN), "2026-01-03").collect()
    first = {(r["scenario_id"], r["bank_account_id"], str(r["balance_date"])): r["ending_balance"] for r in early}
    assert first[("base", "a", "2026-01-03")] == 160.0 and first[("best", "a", "2026-01-04")] == 110.0


def test_actual_events_win_over_estimates(frame):
    from tillflow.operators import timing

    rows = frame("term_id string, transaction_date date, channel string",
                 ("s", "2026-01-05", "web"), ("s", "2026-01-10", "web"), ("s", "2026-01-11", "web"),
                 ("p", "2026-01-05", "web"), ("s", "2026-01-05", "shop"), ("s", "2026-01-05", None), ("o", "2026-01-05", "web"))
    terms = frame("term_id string, lag_days bigint, settlement_period_days bigint, settlement_lag_days bigint, "
                  "weekend_handling string, payment_timing string",
                  ("s", 1, None, None, None, "with_settlement"), ("p", None, None, None, None, "with_payout"),
                  ("o", 2, None, None, None, None))
    events = frame("channel string, event_kind string, event_date date",
                   ("web", "settlement", "2026-01-10"), ("web", "settlement", "2026-01-04"),
                   ("web", "payout", "2026-01-08"), (None, "settlement", "2026-01-09"))
    found = [(r["term_id"], r["channel"], str(r["transaction_date"])[-2:], str(r["cash_date"])[-2:])
             for r in timing.apply_payment_timing(rows, terms, events=events).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [
        ("s", "web", "05", "10"), ("s", "web", "10", "10"), ("s", "web", "11", "12"), ("p", "web", "05", "08"),
        ("s", "shop", "05", "06"), ("s", None, "05", "09"), ("o", "web", "05", "07")]))


def test_a_hot_channel_reaches_the_window_as_days(tables):
    from tillflow.operators import timing

    rows = tables.raw("lineitem").selectExpr("'all' AS channel", "to_date(l_shipdate) AS day")
    plan = timing.next_event(rows, tables.channel_events.selectExpr("'all' AS channel", "event_date"), ["channel"], "day")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window") < text.index("HashAggregate")  # summed to days below the window
    assert "NestedLoop" not in text and "Cartesian" not in text
