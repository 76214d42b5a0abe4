"""Schedules against a payment-by-payment simulation and known totals."""

import datetime as dt

import pytest

from tillflow.operators import debt

LOAN = ("loan_id string, loan_name string, lender string, current_balance double, "
        "annual_rate double, payment_day int, start_date date, maturity_date date, io_months int, "
        "amort_months int, fixed_payment double, balloon_amount double")
AS_OF = "2026-02-25"


def loan(name, balance, rate, day, start, maturity, io=0, amort=0, fixed=None, balloon=None):
    return (name, name.title(), "Example Bank", balance, rate, day, start, maturity, io, amort,
            fixed, balloon)


CASES = [
    loan("revolver", 350000.0, 0.1075, 30, "2024-05-30", "2031-05-30", io=25, amort=60),
    loan("equipment", 31040.0, 0.116516, 15, "2025-03-15", "2030-03-15", amort=60),
    loan("term", 62000.0, 0.115, 1, "2024-01-01", "2027-01-01", amort=36),
    loan("free", 1200.0, 0.0, 31, "2024-01-31", "2025-01-31", amort=12),
    loan("payoff", 10000.0, 0.08, 31, "2024-01-31", "2030-01-31", fixed=900.0),
    loan("growing", 10000.0, 0.12, 10, "2024-01-20", "2025-01-05", fixed=50.0),
    loan("free fixed", 1000.0, 0.0, 10, "2024-01-20", "2030-01-05", fixed=300.0),
    loan("io fixed", 5000.0, 0.05, 31, "2024-10-31", "2026-10-31", io=3, fixed=400.0),
    loan("balloon", 480000.0, 0.065, 1, "2024-01-01", "2029-01-01", fixed=3250.0, balloon=450000.0),
    loan("paid balloon", 5000.0, 0.03, 15, "2024-01-31", "2025-06-10", fixed=1000.0, balloon=1.0),
    loan("late balloon", 5000.0, 0.03, 5, "2024-01-31", "2025-06-10", io=2, fixed=100.0, balloon=4000.0),
    loan("no term", 5000.0, 0.03, 5, "2024-01-31", "2024-01-31", fixed=100.0, balloon=4000.0),
]


def on_day(start, months, day):
    """``day`` of the month ``months`` later, or that month's last day."""
    index = start.year * 12 + start.month - 1 + months
    first = dt.date(index // 12, index % 12 + 1, 1)
    following = dt.date((index + 1) // 12, (index + 1) % 12 + 1, 1)
    return min(first + dt.timedelta(days=day - 1), following - dt.timedelta(days=1))


def simulate(case):
    """(date, payment, principal, interest, ending) one payment after the other."""
    _, _, _, owed, rate, day, start, maturity, io, amort, fixed, balloon = case
    start, maturity = dt.date.fromisoformat(start), dt.date.fromisoformat(maturity)
    out, month = [], rate / 12

    def pay(principal, when=None, payment=None, ending=None):
        nonlocal owed
        interest = owed * month
        left = max(0.0, owed - principal) if ending is None else ending
        out.append((when or on_day(start, len(out), day),
                    principal + interest if payment is None else payment, principal, interest, left))
        owed = left

    for _ in range(io):
        pay(0.0)
    if amort:
        for left in range(amort, 0, -1):
            level = owed / left if month == 0 else owed * month / (1 - (1 + month) ** -left)
            pay(min(level - owed * month, owed))
    elif balloon is None:
        previous = start
        while owed > 1e-6 and previous <= maturity:
            previous = on_day(start, len(out), day)
            pay(min(fixed - owed * month, owed))
    else:
        while start < maturity and on_day(start, len(out), day) < maturity:
            pay(fixed - owed * month, payment=fixed)
        pay(owed, when=maturity, payment=balloon, ending=0.0)
    return out


@pytest.fixture(scope="module")
def schedule(spark):
    from pyspark.sql import functions as F

    plain = LOAN.replace(" date", " string")
    loans = spark.createDataFrame(CASES, plain)
    loans = loans.withColumns({c: F.to_date(c) for c in ("start_date", "maturity_date")})
    found = {}
    for row in debt.loan_schedule(loans, AS_OF).collect():
        found.setdefault(row["loan_id"], []).append(row)
    return {k: sorted(v, key=lambda r: r["payment_number"]) for k, v in found.items()}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_closed_form_equals_simulation(case, schedule):
    wanted, got = simulate(case), schedule[case[0]]
    assert len(got) == len(wanted)
    assert [r["payment_number"] for r in got] == list(range(1, len(got) + 1))
    for row, (when, payment, principal, interest, ending) in zip(got, wanted):
        assert row["payment_date"] == when
        assert row["payment_amount"] == pytest.approx(payment, abs=0.00501)
        assert row["principal_amount"] == pytest.approx(principal, abs=0.00501)
        assert row["interest_amount"] == pytest.approx(interest, abs=0.00501)
        assert row["ending_principal"] == pytest.approx(ending, abs=0.00501)


def total(rows, column):
    return round(sum(r[column] for r in rows), 2)


def test_known_totals(schedule):
    revolver = schedule["revolver"]
    assert len(revolver) == 85
    assert (revolver[0]["payment_amount"], revolver[30]["payment_amount"]) == (3135.42, 7566.28)
    assert total(revolver, "principal_amount") == pytest.approx(350000, abs=0.5)
    assert total(revolver, "payment_amount") == pytest.approx(532362.30, abs=0.5)
    equipment = schedule["equipment"]
    assert equipment[0]["payment_amount"] == 685.02
    assert equipment[0]["principal_amount"] == 383.63
    assert total(equipment, "payment_amount") == pytest.approx(41101.20, abs=0.01)
    balloon = schedule["balloon"]
    assert (len(balloon), balloon[-1]["beginning_principal"]) == (61, 434061.92)
    assert (balloon[-1]["payment_amount"], balloon[-1]["interest_amount"]) == (450000.0, 2351.17)


def test_status_splits_on_the_payment_date(schedule):
    for rows in schedule.values():
        for row in rows:
            assert row["is_paid"] == (row["payment_date"] < dt.date.fromisoformat(AS_OF))
            assert row["is_forecast"] != row["is_paid"]


def test_revolver_end_date_is_inclusive(frame):
    loans = frame(LOAN + ", io_end_date date",
                  loan("r", 350000.0, 0.1075, 30, "2024-05-30", "2031-05-30", amort=60)
                  + ("2026-05-30",))
    rows = debt.schedule_revolver(loans, AS_OF).collect()
    kinds = [r["payment_type"] for r in rows]
    assert (kinds.count("Interest Only"), kinds.count("Principal & Interest")) == (25, 60)


def test_revolver_without_level_months_and_up_to_maturity(frame):
    loans = frame(LOAN + ", io_end_date date",
                  loan("io", 1000.0, 0.12, 30, "2024-05-30", "2031-05-30") + ("2025-05-30",),
                  loan("cut", 1000.0, 0.12, 30, "2024-05-30", "2025-08-30", amort=60) + ("2025-05-30",))
    kinds = [(r["loan_id"], r["payment_type"])
             for r in debt.schedule_revolver(loans, AS_OF, to_maturity=True).collect()]
    assert kinds.count(("io", "Interest Only")) == 13 and kinds.count(("cut", "Interest Only")) == 13
    assert kinds.count(("cut", "Principal & Interest")) == 3 and len(kinds) == 29


def test_whole_tables_are_registered(spark):
    from conftest import FOLDER
    from tillflow.operators import metrics
    from tillflow.plans import registry
    from tillflow.plans.registry import AS_OF
    from tillflow.sources.adapters import TestTables

    queries, tables = registry.load(), TestTables(spark, FOLDER)
    rows = queries["schedule_revolver_all_loans"].run(spark, FOLDER)
    assert rows.select("loan_id").distinct().count() == tables.loans.count()
    weeks = {r.week_start: r.outflows for r in queries["cash_buffer_flags_ledger"].run(spark, FOLDER).collect()}
    assert weeks == {r.week_start: r.outflows for r in queries["cash_buffer_flags"].run(spark, FOLDER).collect()}
    planned = {r.week_start: r.outflows for r in metrics.weekly_in_out(tables.planned_ledger, AS_OF).collect()}
    assert set(planned) <= set(weeks) and sum(weeks.values()) > sum(planned.values())
    rows = queries["schedule_revolver"].run(spark, FOLDER)
    assert rows.select("loan_id").distinct().count() == tables.loans.count()


def test_a_large_loan_keeps_its_small_last_payment(spark):
    from pyspark.sql import functions as F

    loan = ("big", "n", "l", 1e12, 0.0, 1, "2026-01-01", "2027-01-01", 0, 0, 499_999_999_998.0, None)
    loans = spark.createDataFrame([loan], LOAN.replace(" date", " string"))
    loans = loans.withColumns({c: F.to_date(c) for c in ("start_date", "maturity_date")})
    rows = debt.schedule_fixed_payment(loans).orderBy("payment_number").collect()
    assert [r["principal_amount"] for r in rows] == [499_999_999_998.0, 499_999_999_998.0, 4.0]
    assert rows[-1]["ending_principal"] == 0.0


def test_variable_revolver_follows_draws_and_rates(frame):
    import datetime as dt

    lines = frame("loan_id string, loan_name string, lender string, current_balance double, annual_rate double, payment_day int, "
                  "start_date date, maturity_date date, io_end_date date, io_months int, amort_months int, fixed_payment double, "
                  "balloon_amount double, spread double",
                  ("r", "R", "B", 1000.0, 0.0, 30, "2026-01-10", "2031-01-01", "2026-04-20", 0, 12, None, None, 0.02),
                  ("idle", "I", "B", 0.0, 0.0, 1, "2026-01-10", "2031-01-01", "2026-03-01", 0, 12, None, None, 0.02))
    moves = frame("loan_id string, movement_date date, amount double", ("r", "2026-01-20", 500.0), ("r", "2026-02-28", -300.0),
                  ("r", "2026-02-28", 100.0), ("r", "2026-03-31", 250.5), ("r", "2025-12-01", 9999.0), ("r", "2026-04-20", 9999.0),
                  ("other", "2026-02-01", 9.0))
    rates = frame("effective_date date, base_rate double", ("2025-06-01", 0.05), ("2026-01-15", 0.06), ("2026-03-01", 0.07),
                  ("2026-04-02", 0.5))
    rows = debt.schedule_variable_revolver(lines, moves, rates, "2026-03-15", "2025-01-01", "2027-12-31").collect()
    assert {r["loan_id"] for r in rows} == {"r"}
    paid = sorted((r for r in rows if r["payment_type"] == "Interest Only"), key=lambda r: r["payment_number"])

    net = {dt.date(2026, 1, 20): 500.0, dt.date(2026, 2, 28): -200.0, dt.date(2026, 3, 31): 250.5}
    rate = {1: 0.05, 2: 0.06, 3: 0.07, 4: 0.07}  # of the first day of the month
    due = [dt.date(2026, 1, 30), dt.date(2026, 2, 28), dt.date(2026, 3, 30), dt.date(2026, 4, 20)]
    balance, day, want, sums = 1000.0, dt.date(2026, 1, 10), [], 0.0
    while day <= due[-1]:
        if day in due:
            want.append(round(sums, 2))
            sums = 0.0
        balance += net.get(day, 0.0)
        sums += balance * (rate[day.month] + 0.02) / 360
        day += dt.timedelta(1)
    assert [r["payment_date"] for r in paid] == due and [r["interest_amount"] for r in paid] == want
    assert [r["beginning_principal"] for r in paid] == [1500.0, 1500.0, 1300.0, 1550.5]
    level = sorted((r for r in rows if r["payment_type"] != "Interest Only"), key=lambda r: r["payment_number"])
    assert len(level) == 12 and level[0]["beginning_principal"] == 1550.5 and level[-1]["ending_principal"] == 0.0
    assert level[0]["payment_number"] == 5 and abs(level[0]["interest_rate"] - 0.09) < 1e-12
    assert [r["is_paid"] for r in paid] == [True, True, False, False]
