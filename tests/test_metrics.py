import pytest

from tillflow.operators import metrics, views

WEEK = "week_start date, week_end date, net_cash_flow double"


def weeks(frame, *nets):
    starts = ["2026-01-05", "2026-01-12", "2026-01-19", "2026-01-26", "2026-02-02"]
    return frame(WEEK, *[(starts[i], starts[i], n) for i, n in enumerate(nets)])


def position(frame, liquidity=100.0):
    return frame("total_cash double, total_liquidity double", (liquidity, liquidity))


def test_override_wins_unless_it_is_no_number(frame):
    def first(override):
        rows = metrics.weekly_balance(weeks(frame, -10.0), position(frame), override).collect()
        return rows[0]["cash_balance"]

    assert [first(None), first("50"), first(" 7.5 "), first("soon"), first("  "), first("")] == \
        [90.0, 40.0, -2.5, 90.0, 90.0, 90.0]


def flags(frame, *nets, start="100"):
    balances = metrics.weekly_balance(weeks(frame, *nets), position(frame), start)
    return ([r["risk_flag"] for r in metrics.risk_flags(balances).collect()],
            metrics.runway(balances).first()["runway_weeks"],
            metrics.burn_rate(balances).first()["burn_rate"])


def test_short_runway_with_recovery(frame):
    assert flags(frame, -50.0, -60.0, 200.0) == (["Runway under 4 weeks (2 weeks)"], 2, 0.0)


def test_negative_end(frame):
    found, runway, burn = flags(frame, -10.0, -10.0, -10.0, -10.0, -90.0)
    assert found == ["Ending cash balance is negative"]
    assert (runway, burn) == (5, 26.0)


def test_no_risk(frame):
    assert flags(frame, 5.0) == (["No high-priority risk flags"], None, 0.0)


def test_no_weeks_at_all(frame):
    none = weeks(frame, 1.0).where("net_cash_flow < 0")
    balances = metrics.weekly_balance(none, position(frame))
    assert metrics.dashboard_kpis(balances, position(frame)).first().asDict() == {
        "cash_position": 100.0, "runway_weeks": None, "burn_rate": 0.0}
    assert metrics.risk_flags(balances).first()["risk_flag"] == "No high-priority risk flags"


def test_buffer_levels(frame):
    balances = frame("cash_balance double", (49999.0,), (50000.0,), (100000.0,))
    found = [r["buffer_status"] for r in metrics.cash_buffer_flags(balances).collect()]
    assert found == ["below_minimum", "below_target", "on_target"]


LEDGER = ("cash_date date, cash_flow_section string, cash_flow_category string, amount double, "
          "is_forecast boolean, scenario_id string, description string")


def test_scenario_rows(frame):
    ledger = frame(LEDGER, ("2026-01-01", "Operating", "A", 1.0, False, None, ""),
                   ("2026-01-01", "Operating", "A", 2.0, True, "base", ""),
                   ("2026-01-01", "Operating", "A", 4.0, True, "best", ""),
                   ("2025-01-01", "Operating", "A", 8.0, False, None, ""))
    total = sum(r["amount"] for r in metrics.scenario_ledger(ledger, "2026-01-05").collect())
    assert total == 3.0
    compared = metrics.scenario_comparison(ledger, "2026-01-05").collect()
    assert {(r["scenario_id"], r["cash_balance"]) for r in compared} == {
        (None, 1.0), ("base", 2.0), ("best", 4.0)}


BALANCE = ("balance_date date, bank_account_id string, account_type string, "
           "ending_balance double, available_credit double, is_forecast boolean")


def test_position_uses_the_latest_actual_day(frame):
    rows = frame(BALANCE, ("2026-01-01", "a", "Savings", 999.0, None, False),
                 ("2026-01-02", "b", "Checking", 10.0, None, False),
                 ("2026-01-02", "c", "LOC", -40.0, 60.0, False),
                 ("2026-01-02", "d", "Credit Card", -5.0, None, False),
                 ("2026-01-03", "b", "Checking", 77.0, None, True))
    assert views.cash_position(rows).first().asDict() == {
        "total_cash": 10.0, "total_loc_balance": 40.0, "total_loc_available": 60.0,
        "total_liquidity": 70.0}
    assert views.cash_position(rows.where("is_forecast")).first()["total_cash"] is None


@pytest.mark.parametrize("limit", [1, 3])
def test_top_days(frame, limit):
    ledger = frame("cash_date date, cash_flow_category string, amount double",
                   ("2026-01-01", "A", 5.0), ("2026-01-01", "A", 5.0), ("2026-01-02", "A", 7.0),
                   ("2026-01-03", "A", -7.0))
    found = [r["revenue"] for r in views.top_revenue_days(ledger, limit).collect()]
    assert found == [10.0, 7.0][:limit]
