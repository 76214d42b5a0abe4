"""Loan schedules and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.operators import debt
from tillflow.plans.registry import AS_OF, register
from tillflow.plans.views import LEVEL, cents, pay_date

register("monthly_interest",
         lambda t: t.loans.select("loan_id", debt.monthly_interest(
             F.col("current_balance"), F.col("annual_rate")).alias("interest")),
         "SELECT loan_id, current_balance * (annual_rate / 360) * 30 AS interest FROM loans")
register("level_payment",
         lambda t: t.loans.select("loan_id", debt.level_payment(
             F.col("current_balance"), F.col("annual_rate"), F.col("amort_months")).alias("raw"))
         .select("loan_id", debt.cents(F.col("raw")).alias("payment")), f"""
SELECT loan_id, {cents('payment')} AS payment
FROM (SELECT loan_id, CASE WHEN amort_months = 0 THEN current_balance
                           WHEN annual_rate = 0 THEN current_balance / amort_months
                           ELSE current_balance * ((annual_rate / 12) * pow(1 + annual_rate / 12, amort_months))
                                / (pow(1 + annual_rate / 12, amort_months) - 1) END AS payment
      FROM loans)""")
register("payment_dates", lambda t: debt.payment_dates(t.loans, 60), f"""
SELECT loan_id, payment_number, {pay_date('payment_number - 1')} AS payment_date
FROM (SELECT *, CAST(unnest(range(1, 61)) AS INTEGER) AS payment_number FROM loans)""")
register("schedule_interest_only", lambda t: debt.schedule_interest_only(t.loans),
         "SELECT * FROM interest_only")
register("schedule_amortising", lambda t: debt.schedule_amortising(t.loans),
         "SELECT * FROM amortising")
register("schedule_fixed_payment", lambda t: debt.schedule_fixed_payment(t.loans),
         "SELECT * FROM fixed_payment_rows")
register("schedule_balloon", lambda t: debt.schedule_balloon(t.loans),
         "SELECT * FROM balloon_regular UNION ALL SELECT * FROM balloon_final")
register("schedule_revolver",
         lambda t: debt.schedule_revolver(t.loans, AS_OF), f"""
SELECT loan_id, loan_name, lender, payment_date, payment_number, {cents('payment')} AS payment_amount,
       {cents('principal')} AS principal_amount, {cents('interest')} AS interest_amount,
       CAST(0.0 AS DOUBLE) AS fees_amount, {cents('beginning')} AS beginning_principal,
       {cents('ending')} AS ending_principal, annual_rate AS interest_rate, 30 AS days_in_period, payment_type,
       payment_date < DATE '{{AS_OF}}' AS is_paid, payment_date >= DATE '{{AS_OF}}' AS is_forecast
FROM (SELECT *, CASE WHEN step < 0 THEN CAST(0.0 AS DOUBLE) ELSE least(level - interest, beginning) END AS principal,
             CASE WHEN step < 0 THEN interest ELSE least(level - interest, beginning) + interest END AS payment,
             CASE WHEN step < 0 THEN 'Interest Only' ELSE 'Principal & Interest' END AS payment_type
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest,
                   CASE WHEN annual_rate = 0 THEN current_balance / amort_months
                        ELSE current_balance * ((annual_rate / 12) * pow(1 + annual_rate / 12, amort_months))
                             / (pow(1 + annual_rate / 12, amort_months) - 1) END AS level
            FROM (SELECT *, CASE WHEN step < 0 THEN current_balance ELSE {LEVEL.format(k='step')} END AS beginning,
                         CASE WHEN step < 0 THEN current_balance ELSE {LEVEL.format(k='(step + 1)')} END AS ending,
                         CAST(io + step + 1 AS INTEGER) AS payment_number, {pay_date('io + step')} AS payment_date
                  FROM (SELECT *, unnest(range(-io, amort_months)) AS step
                        FROM (SELECT *, datediff('month', start_date, io_end_date) + 1 AS io FROM loans)))))""")
# No level payment after maturity.
register("schedule_revolver_all_loans",
         lambda t: debt.schedule_revolver(t.loans, AS_OF, to_maturity=True), f"""
SELECT loan_id, loan_name, lender, payment_date, payment_number, {cents('payment')} AS payment_amount,
       {cents('principal')} AS principal_amount, {cents('interest')} AS interest_amount,
       CAST(0.0 AS DOUBLE) AS fees_amount, {cents('beginning')} AS beginning_principal,
       {cents('ending')} AS ending_principal, annual_rate AS interest_rate, 30 AS days_in_period, payment_type,
       payment_date < DATE '{{AS_OF}}' AS is_paid, payment_date >= DATE '{{AS_OF}}' AS is_forecast
FROM (SELECT *, CASE WHEN step < 0 THEN CAST(0.0 AS DOUBLE) ELSE least(level - interest, beginning) END AS principal,
             CASE WHEN step < 0 THEN interest ELSE least(level - interest, beginning) + interest END AS payment,
             CASE WHEN step < 0 THEN 'Interest Only' ELSE 'Principal & Interest' END AS payment_type
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest,
                   CASE WHEN step < 0 THEN NULL
                        WHEN annual_rate = 0 THEN current_balance / amort_months
                        ELSE current_balance * ((annual_rate / 12) * pow(1 + annual_rate / 12, amort_months))
                             / (pow(1 + annual_rate / 12, amort_months) - 1) END AS level
            FROM (SELECT *, CASE WHEN step < 0 THEN current_balance ELSE {LEVEL.format(k='step')} END AS beginning,
                         CASE WHEN step < 0 THEN current_balance ELSE {LEVEL.format(k='(step + 1)')} END AS ending,
                         CAST(io + step + 1 AS INTEGER) AS payment_number, {pay_date('io + step')} AS payment_date
                  FROM (SELECT *, unnest(range(-io, amort_months)) AS step
                        FROM (SELECT *, datediff('month', start_date, io_end_date) + 1 AS io FROM loans))
                  WHERE step < 0
                     OR start_date + to_months(CAST(io + step AS INTEGER)) <= maturity_date)))""")
# Draws and repayments from the orders, a base rate that changes often, a spread per line.
register("schedule_variable_revolver",
         lambda t: debt.schedule_variable_revolver(t.credit_lines, t.credit_movements, t.base_rates, AS_OF,
                                                   "1990-01-01", "2010-12-31"), f"""
SELECT loan_id, loan_name, lender, payment_date,
       CAST(row_number() OVER (PARTITION BY loan_id ORDER BY payment_date) AS INTEGER) AS payment_number,
       {cents('interest')} AS payment_amount, CAST(0.0 AS DOUBLE) AS principal_amount, {cents('interest')} AS interest_amount,
       CAST(0.0 AS DOUBLE) AS fees_amount, {cents('CAST(held AS DOUBLE)')} AS beginning_principal,
       {cents('CAST(held AS DOUBLE)')} AS ending_principal, rate AS interest_rate, 30 AS days_in_period,
       'Interest Only' AS payment_type, payment_date < DATE '{{AS_OF}}' AS is_paid, payment_date >= DATE '{{AS_OF}}' AS is_forecast
FROM line_payments UNION ALL
SELECT loan_id, loan_name, lender, payment_date, CAST(paid + step + 1 AS INTEGER), {cents('payment')}, {cents('principal')},
       {cents('interest')}, 0.0, {cents('beginning')}, {cents('ending')}, annual_rate, 30, 'Principal & Interest',
       payment_date < DATE '{{AS_OF}}', payment_date >= DATE '{{AS_OF}}'
FROM (SELECT *, least(level - interest, beginning) AS principal, least(level - interest, beginning) + interest AS payment
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest,
                   CASE WHEN annual_rate = 0 THEN current_balance / amort_months
                        ELSE current_balance * ((annual_rate / 12) * pow(1 + annual_rate / 12, amort_months))
                             / (pow(1 + annual_rate / 12, amort_months) - 1) END AS level
            FROM (SELECT *, {LEVEL.format(k='step')} AS beginning, {LEVEL.format(k='(step + 1)')} AS ending,
                         {pay_date('step')} AS payment_date
                  FROM (SELECT *, unnest(range(0, amort_months)) AS step
                        FROM (SELECT l.loan_id, l.loan_name, l.lender, l.payment_day, l.amort_months, coalesce(p.paid, 0) AS paid,
                                     CAST(l.io_end_date + INTERVAL 1 MONTH AS DATE) AS start_date,
                                     r.base_rate + l.spread AS annual_rate, CAST(b.owed AS DOUBLE) AS current_balance
                              FROM credit_lines l JOIN rate_months r ON r.month = CAST(date_trunc('month', l.io_end_date) AS DATE)
                              JOIN (SELECT loan_id, arg_max(owed, day) AS owed FROM line_balances GROUP BY loan_id) b ON b.loan_id = l.loan_id
                              LEFT JOIN (SELECT loan_id, count(*) AS paid FROM line_payments GROUP BY loan_id) p ON p.loan_id = l.loan_id
                              WHERE b.owed > 0 AND l.amort_months > 0)))))""")
register("loan_status", lambda t: t.debt_schedule(AS_OF), "SELECT * FROM schedule")
register("schedule_totals", lambda t: debt.schedule_totals(t.debt_schedule(AS_OF)), """
SELECT loan_id, CAST(SUM(CAST(principal_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_principal,
       CAST(SUM(CAST(interest_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_interest,
       CAST(SUM(CAST(payment_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_payments,
       COUNT(*) AS payment_count FROM schedule GROUP BY loan_id""")
register("debt_by_loan", lambda t: debt.debt_by_loan(t.debt_schedule(AS_OF)), """
SELECT loan_name, lender, COUNT(*) AS payment_count, MIN(payment_date) AS first_payment,
       MAX(payment_date) AS last_payment,
       CAST(SUM(CAST(payment_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_payments,
       CAST(SUM(CAST(principal_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_principal,
       CAST(SUM(CAST(interest_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_interest
FROM schedule GROUP BY loan_name, lender""")
register("upcoming_payments", lambda t: debt.upcoming_payments(t.debt_schedule(AS_OF), AS_OF), """
SELECT payment_date, loan_name, payment_type, payment_amount AS payment, principal_amount AS principal,
       interest_amount AS interest, ending_principal AS remaining_balance
FROM schedule WHERE NOT is_paid AND payment_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 91""")
register("loan_payments", lambda t: debt.loan_payments(t.debt_schedule(AS_OF), "loan-10"), """
SELECT payment_date, payment_number, payment_amount AS payment, principal_amount AS principal,
       interest_amount AS interest, ending_principal AS balance
FROM schedule WHERE loan_id = 'loan-10' ORDER BY payment_date, payment_number LIMIT 20""")
register("active_loan_summary", lambda t: debt.active_loan_summary(t.debt_schedule(AS_OF)), """
SELECT loan_name, lender, COUNT(*) AS total_payments,
       CAST(SUM(CAST(payment_amount AS DECIMAL(18,4))) AS DOUBLE) AS total_payments_amount,
       MAX(payment_date) AS final_payment_date
FROM schedule WHERE NOT is_paid GROUP BY loan_name, lender""")
