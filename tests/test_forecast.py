import pytest

from tillflow.operators import forecast

AS_OF = "2026-01-28"
LEDGER = ("cash_date date, cash_flow_section string, cash_flow_category string, "
          "counterparty string, amount double, is_forecast boolean")
RECURRING = ("recurring_id string, transaction_name string, cash_flow_category string, "
             "amount double, frequency string, recurrence_interval bigint, day_of_month bigint, "
             "start_date date, end_date date, is_active boolean")
DEBT = ("payment_date date, loan_name string, lender string, payment_amount double, "
        "principal_amount double, interest_amount double, is_paid boolean")


def recurring(frame):
    def item(key, category, day, start="2025-01-01", end=None, active=True):
        return (key, key, category, -10.0, "Quarterly", 3, day, start, end, active)

    return frame(RECURRING, item("one", "OpEx", 1), item("thirty", "Loan Fees", 30),
                 item("thirtyone", "Debt Service", 31), item("off", "OpEx", 1, active=False),
                 item("ended", "OpEx", 1, end="2026-01-27"), item("late", "OpEx", 1, start="2026-02-01"))


def test_recurring_days_and_sections(frame):
    active = forecast.active_recurring(recurring(frame), AS_OF)
    lines = forecast.forecast_recurring_lines(active, AS_OF, 13).collect()
    found = {}
    for r in lines:
        found.setdefault(r["description"], []).append((str(r["transaction_date"]), r["week_number"]))
        assert r["week_start"] <= r["transaction_date"] <= r["week_end"]
    # 13 weeks from 28 January: no 30 or 31 in February, none of 31 in April
    assert sorted(found["one (recurring)"]) == [("2026-02-01", 1), ("2026-03-01", 5), ("2026-04-01", 10)]
    assert [d for d, _ in sorted(found["thirty (recurring)"])] == ["2026-01-30", "2026-03-30"]
    assert [d for d, _ in sorted(found["thirtyone (recurring)"])] == ["2026-01-31", "2026-03-31"]
    assert set(found) == {"one (recurring)", "thirty (recurring)", "thirtyone (recurring)"}
    sections = {r["description"]: r["cash_flow_section"] for r in lines}
    assert sections == {"one (recurring)": "Operating", "thirty (recurring)": "Financing",
                        "thirtyone (recurring)": "Financing"}


def test_debt_window_keeps_the_last_day_but_weeks_drop_it(frame):
    debt = frame(DEBT, ("2026-01-27", "L", "B", 1.0, 1.0, 0.0, False),
                 ("2026-01-28", "L", "B", 2.0, 1.0, 1.0, False),
                 ("2026-02-03", "L", "B", 3.0, 1.0, 1.0, False),
                 ("2026-02-11", "L", "B", 4.0, 1.0, 1.0, False),
                 ("2026-02-05", "L", "B", 5.0, 1.0, 1.0, True))
    due = forecast.upcoming_debt(debt, AS_OF, 2)
    assert sorted(r["payment_amount"] for r in due.collect()) == [2.0, 3.0, 4.0]
    lines = forecast.forecast_debt_lines(due, AS_OF, 2).collect()
    assert sorted((r["week_number"], r["amount"]) for r in lines) == [(1, -3.0), (1, -2.0)]


def ledger(frame, *rows):
    return frame(LEDGER, *rows)


def test_expense_average_covers_at_least_a_week(frame):
    actuals = ledger(frame, ("2026-01-01", "Operating", "A", "x", -70.0, False),
                     ("2026-01-03", "Operating", "B", "x", -30.0, False),
                     ("2026-01-03", "Operating", "R", "x", 500.0, False))
    row = forecast.expense_pattern(actuals).first()
    assert (row["total_expenses"], row["weeks_in_range"], row["weekly_avg"]) == (100.0, 1.0, 100.0)
    trend = forecast.revenue_trend(actuals).first()
    assert (trend["total_revenue"], trend["weekly_std"]) == (500.0, 0.0)
    assert forecast.revenue_split(actuals).first()["share_pct"] == 100.0


def test_lookback_has_no_upper_end(frame):
    rows = ledger(frame, ("2025-11-04", "Operating", "A", "x", -1.0, False),
                  ("2025-11-05", "Operating", "A", "x", -1.0, False),
                  ("2030-01-01", "Operating", "A", "x", -1.0, False),
                  ("2026-01-01", "Operating", "A", "x", -1.0, True))
    assert forecast.historical_actuals(rows, AS_OF, 12).count() == 2


@pytest.fixture
def lines(frame):
    history = ledger(frame, ("2026-01-01", "Operating", "A", "x", -70.0, False))
    no_debt = frame(DEBT, ("2020-01-01", "L", "B", 1.0, 1.0, 0.0, False))
    return forecast.weekly_forecast(history, recurring(frame), no_debt, AS_OF, 4,
                                    ("base", "best", "worst", "odd"), weekly_revenue=1000.0)


def test_scenarios_scale_revenue_and_expenses_only(lines):
    found = {}
    for r in lines.collect():
        found.setdefault((r["scenario"], r["cash_flow_category"]), []).append(r["amount"])
    assert found["best", "Revenue - Ecommerce"] == [1150.0] * 4
    assert found["worst", "Operating Expenses"] == pytest.approx([-77.0] * 4)
    assert found["odd", "Operating Expenses"] == found["base", "Operating Expenses"] == [-70.0] * 4
    assert found["best", "Loan Fees"] == found["worst", "Loan Fees"] == [-10.0]


def test_no_history_gives_zero_expenses(frame):
    empty = ledger(frame, ("2020-01-01", "Operating", "A", "x", -70.0, False))
    debt = frame(DEBT, ("2020-01-01", "L", "B", 1.0, 1.0, 0.0, False))
    out = forecast.weekly_forecast(empty, recurring(frame).where("recurring_id = 'off'"), debt,
                                   AS_OF, 3).collect()
    assert [r["amount"] for r in out] == [0.0, 0.0, 0.0]


def test_documented_weeks(frame):
    nets = [-108572.0, -105137.0, -105137.0]
    weekly = frame("scenario string, week_number int, week_start date, week_end date, amount double",
                   *[("base", k + 1, f"2026-02-{1 + 7 * k:02d}", f"2026-02-{7 + 7 * k:02d}", net)
                     for k, net in enumerate(nets)])
    rows = sorted(forecast.cash_position_runway(weekly, 250000.0).collect(),
                  key=lambda r: r["week_number"])
    assert [r["cash_balance"] for r in rows] == [141428.0, 36291.0, -68846.0]
    assert {r["runway_weeks"] for r in rows} == {3}


def test_rollup_ties_to_lines(lines):
    rollup = [r for r in forecast.cash_forecast_rollup(lines, 500.0, AS_OF).collect()
              if r["scenario_id"] == "base"]
    rollup.sort(key=lambda r: r["week_number"])
    assert rollup[0]["beginning_cash"] == 500.0
    for row in rollup:
        assert row["ending_cash"] == pytest.approx(row["beginning_cash"] + row["net_cash_flow"])
        assert row["operating_cash_flow"] == row["operating_inflows"] - row["operating_outflows"]
    assert rollup[-1]["avg_weekly_burn"] == 0.0


def test_forecast_rows_are_ledger_rows(lines):
    row = forecast.forecast_to_ledger(lines).where("scenario_id = 'best'").first()
    assert row["is_forecast"] and row["currency"] == "USD" and row["tags"] is None
    assert row["cash_date"] == row["value_date"] == row["transaction_date"]


def test_every_frequency(frame):
    items = frame("recurring_id string, frequency string, recurrence_interval bigint, day_of_week bigint, day_of_month bigint, "
                  "month_of_year bigint, start_date date, end_date date",
                  ("daily", "Daily", 10, None, None, None, "2026-01-01", None),
                  ("daily-end", "Daily", 1, None, None, None, "2025-12-01", "2026-01-07"),
                  ("weekly", "Weekly", 2, 5, None, None, "2026-01-01", None),     # Fridays from 2 January
                  ("weekly-own", "Weekly", 1, None, None, None, "2025-12-31", None),
                  ("monthly", "Monthly", 1, None, 31, None, "2025-01-31", None),  # months without a 31st have none
                  ("second", "Monthly", 2, None, 15, None, "2025-12-15", None),
                  ("quarter", "Quarterly", 1, None, 31, None, "2025-11-30", None),  # clamped to 28 February
                  ("quarter-end", "Quarterly", 1, None, 10, None, "2025-11-10", "2026-02-09"),
                  ("annual", "Annually", 1, None, 30, 2, "2020-05-01", None),
                  ("annual-own", "Annually", 1, None, None, None, "2024-02-29", None),
                  ("annual-second", "Annually", 2, None, 1, None, "2025-03-01", None),
                  ("unknown", None, None, None, 20, None, "2025-01-01", None))
    found = {}
    for r in forecast.occurrences(items, "2026-01-05", 9).collect():  # to 8 March
        found.setdefault(r["recurring_id"], []).append(str(r["transaction_date"])[5:])
    assert {k: sorted(v) for k, v in found.items()} == {
        "daily": ["01-11", "01-21", "01-31", "02-10", "02-20", "03-02"], "daily-end": ["01-05", "01-06", "01-07"],
        "weekly": ["01-16", "01-30", "02-13", "02-27"],
        "weekly-own": ["01-07", "01-14", "01-21", "01-28", "02-04", "02-11", "02-18", "02-25", "03-04"],
        "monthly": ["01-31"], "second": ["02-15"], "quarter": ["02-28"], "annual": ["02-28"],
        "annual-own": ["02-28"], "unknown": ["01-20", "02-20"]}


def test_a_week_across_a_month_end_has_both_factors(frame):
    base = frame("weekly_revenue double", (700.0,))
    rows = forecast.forecast_revenue_lines(base, "2026-03-28", 2, seasonal=True).collect()
    # 28 to 31 March at 0.6, 1 to 3 April at 1; then April alone
    assert [round(r["amount"], 6) for r in sorted(rows, key=lambda r: r["week_number"])] == [540.0, 700.0]


def test_the_baseline_is_free_of_the_season(frame):
    ledger = frame("cash_date date, amount double, is_forecast boolean",
                   ("2026-01-10", 31 * 0.6 * 10, False), ("2026-02-10", 28 * 0.6 * 10, False), ("2026-03-10", 31 * 0.6 * 10, False),
                   ("2025-12-31", 999.0, False), ("2026-04-01", 999.0, False), ("2026-02-11", -5.0, False), ("2026-02-12", 9.0, True))
    assert round(forecast.seasonal_baseline(ledger, "2026-04-01").first()[0], 6) == 70.0
    assert forecast.seasonal_baseline(ledger.limit(0), "2026-04-01").first()[0] == 0.0


def test_stored_scenarios_come_before_the_defaults(frame):
    stored = frame("scenario_id string, revenue_growth_rate double, expense_inflation_rate double, custom_assumptions string, "
                   "is_active boolean", ("best", 0.2, None, None, True), ("mine", 0.5, 0.1, '{"expense_factor": 2}', None),
                   ("worst", 9.0, 9.0, None, False), ("odd", None, None, "no json", True))
    asked = frame("scenario string", ("best",), ("mine",), ("worst",), ("odd",), ("none",), (None,))
    found = {r["scenario"]: (r["revenue_factor"], r["expense_factor"])
             for r in forecast.scenario_factors(asked, stored=stored).collect()}
    assert found == {"best": (1.2, 0.9), "mine": (1.5, 2.0), "worst": (0.85, 1.1), "odd": (1.0, 1.0),
                     "none": (1.0, 1.0), None: (1.0, 1.0)}
    lines = forecast.forecast_opex_lines(frame("weekly_avg double", (100.0,)), "2026-01-05", 1, ("base", "mine"), stored)
    assert {r["scenario"]: r["amount"] for r in lines.collect()} == {"base": -100.0, "mine": -200.0}


def test_expenses_grow_with_inflation(frame):
    rows = forecast.forecast_opex_lines(frame("weekly_avg double", (100.0,)), "2026-01-01", 53, inflation=0.03).collect()
    last = max(rows, key=lambda r: r["week_number"])
    assert abs(last["amount"] + 100.0 * 1.03 ** (370 / 365)) < 1e-9
