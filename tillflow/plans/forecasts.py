"""Forecast inputs, lines and positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.operators import forecast
from tillflow.plans.ledger_reports import planned_lines
from tillflow.plans.registry import AS_OF, SCENARIOS, WEEKS, register
from tillflow.sources.adapters import TestTables

SPAN = (AS_OF, WEEKS, SCENARIOS)
START_BALANCE = 250000.0


def _actuals(t: TestTables):
    return forecast.historical_actuals(t.actual_ledger, AS_OF)


register("historical_actuals", _actuals, """
SELECT cash_date, cash_flow_section, cash_flow_category, counterparty, CAST(amount AS DOUBLE) AS amount
FROM actuals WHERE cash_date >= DATE '{AS_OF}' - 84""")
register("revenue_trend", lambda t: forecast.revenue_trend(_actuals(t)), """
SELECT total AS total_revenue, weeks_in_range, total / weeks_in_range AS weekly_avg,
       CAST(0.0 AS DOUBLE) AS weekly_std
FROM (SELECT CAST(SUM(whole) AS DOUBLE) AS total,
             greatest(CAST(MAX(last_day) - MIN(first_day) AS DOUBLE) / 7, 1.0) AS weeks_in_range FROM revenues)""")
register("revenue_split", lambda t: forecast.revenue_split(_actuals(t)), """
SELECT cash_flow_category, CAST(whole AS DOUBLE) AS revenue,
       CAST(whole * 10000 AS DOUBLE) / (SELECT CAST(SUM(whole) * 10000 AS DOUBLE) FROM revenues) * 100 AS share_pct
FROM revenues""")
register("expense_pattern", lambda t: forecast.expense_pattern(_actuals(t)), """
SELECT total AS total_expenses, weeks_in_range, weekly_avg, CAST(0.0 AS DOUBLE) AS weekly_std
FROM expense_row""")
register("expense_by_category", lambda t: forecast.expense_by_category(_actuals(t)),
         "SELECT cash_flow_category, CAST(whole AS DOUBLE) AS total_amount FROM expenses")
register("active_recurring",
         lambda t: forecast.active_recurring(t.recurring_transactions, AS_OF),
         "SELECT * FROM live_recurring")
register("upcoming_debt", lambda t: forecast.upcoming_debt(t.debt_schedule(AS_OF), AS_OF),
         "SELECT * FROM due_debt")
register("forecast_weeks",
         lambda t: forecast.forecast_weeks(t.vendors.select("Name"), AS_OF, WEEKS),
         'SELECT "Name", week_number, week_start, week_end FROM vendors, weeks')
register("scenario_factors", lambda t: forecast.scenario_factors(t.scenario_requests), """
SELECT request_id, r.scenario, coalesce(f.revenue_factor, 1.0) AS revenue_factor,
       coalesce(f.expense_factor, 1.0) AS expense_factor
FROM (SELECT 'req-' || c_custkey AS request_id,
             CASE c_custkey % 5 WHEN 0 THEN 'base' WHEN 1 THEN 'best' WHEN 2 THEN 'worst'
                  WHEN 3 THEN 'stress' END AS scenario FROM customer) r
LEFT JOIN factors f ON r.scenario = f.scenario""")
register("forecast_revenue_lines",
         lambda t: forecast.forecast_revenue_lines(
             forecast.revenue_trend(_actuals(t)).select(F.col("weekly_avg").alias("weekly_revenue")),
             *SPAN), """
SELECT week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
       'Revenue - Ecommerce' AS cash_flow_category, 'Week ' || week_number || ' - Revenue (forecast)' AS description,
       weekly_avg * revenue_factor AS amount, scenario
FROM (SELECT CAST(SUM(whole) AS DOUBLE)
             / greatest(CAST(MAX(last_day) - MIN(first_day) AS DOUBLE) / 7, 1.0) AS weekly_avg FROM revenues), weeks, factors""")
register("forecast_opex_lines",
         lambda t: forecast.forecast_opex_lines(forecast.expense_pattern(_actuals(t)), *SPAN),
         "SELECT * FROM opex_lines")
register("forecast_recurring_lines",
         lambda t: forecast.forecast_recurring_lines(
             forecast.active_recurring(t.recurring_transactions, AS_OF), *SPAN),
         "SELECT * FROM recurring_lines")
# Items of all five frequencies, intervals 1 to 3, some that end inside the span.
register("forecast_recurring_frequencies",
         lambda t: forecast.forecast_recurring_lines(
             forecast.active_recurring(t.recurring_items, AS_OF), *SPAN, by_frequency=True), """
SELECT week_number, week_start, week_end, transaction_date,
       CASE WHEN contains(cash_flow_category, 'Debt') OR contains(cash_flow_category, 'Loan')
            THEN 'Financing' ELSE 'Operating' END AS cash_flow_section,
       cash_flow_category, description || ' (recurring)' AS description, amount, scenario
FROM item_days, factors WHERE end_date IS NULL OR end_date >= DATE '{AS_OF}'""")

# A week's revenue by the factors of its days, from the trailing three months.
SEASON = "CASE WHEN month({d}) IN (10, 11, 12) THEN 2.5 WHEN month({d}) IN (1, 2, 3) THEN 0.6 ELSE 1.0 END::DOUBLE"
SEASONAL_SQL = f"""
SELECT weeks.week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
       'Revenue - Ecommerce' AS cash_flow_category, 'Week ' || weeks.week_number || ' - Revenue (forecast)' AS description,
       base * (list_reduce(list_transform(range(7), lambda k: {SEASON.format(d='week_start + k::INTEGER')}), lambda a, b: a + b) / 7)
         * factor AS amount, scenario
FROM (SELECT CAST(coalesce(SUM(amount), 0) AS DOUBLE)
             / list_reduce(list_transform(generate_series(DATE '{{AS_OF}}' - INTERVAL 3 MONTH, DATE '{{AS_OF}}' - INTERVAL 1 DAY, INTERVAL 1 DAY),
                                          lambda d: {SEASON.format(d='d')}), lambda a, b: a + b) * 7 AS base
      FROM actuals WHERE amount > 0 AND cash_date >= DATE '{{AS_OF}}' - INTERVAL 3 MONTH AND cash_date < DATE '{{AS_OF}}'), weeks,
     {{factors}}"""


def _seasonal(t: TestTables, as_of: str, scenarios, stored=None):
    return forecast.forecast_revenue_lines(forecast.seasonal_baseline(t.actual_ledger, as_of), as_of, WEEKS,
                                           scenarios, seasonal=True, stored=stored)


register("seasonal_revenue_lines", lambda t: _seasonal(t, AS_OF, SCENARIOS),
         SEASONAL_SQL.replace("{factors}", "(SELECT scenario, revenue_factor AS factor FROM factors)"))
register("inflated_opex_lines",
         lambda t: forecast.forecast_opex_lines(forecast.expense_pattern(_actuals(t)), *SPAN, inflation=0.03), """
SELECT * REPLACE (0.0 - weekly_avg * expense_factor * pow(1.03::DOUBLE, (week_end - DATE '{AS_OF}')::DOUBLE / 365.0::DOUBLE) AS amount)
FROM (SELECT week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
             'Operating Expenses' AS cash_flow_category, 'Week ' || week_number || ' - OpEx (forecast)' AS description,
             0.0::DOUBLE AS amount, scenario, weekly_avg, expense_factor FROM expense_row, weeks, factors)
""".replace("SELECT * REPLACE", "SELECT * EXCLUDE (weekly_avg, expense_factor) REPLACE"))

# Factors of the stored scenarios: custom plans, one that is not active, one without inflation.
PLANS = ("base", "plan-4", "plan-5", "plan-6", "plan-9")
CHOSEN = """(SELECT n.scenario, coalesce(revenue, 1.0::DOUBLE) AS revenue_factor, coalesce(expense, 1.0::DOUBLE) AS expense_factor
      FROM (VALUES ('base'), ('plan-4'), ('plan-5'), ('plan-6'), ('plan-9')) n(scenario) LEFT JOIN stored_factors s ON s.scenario = n.scenario)"""
register("scenario_factors_stored",
         lambda t: forecast.scenario_factors(t.scenario_requests_stored, stored=t.scenarios), """
SELECT request_id, r.scenario, coalesce(revenue, revenue_factor, 1.0::DOUBLE) AS revenue_factor,
       coalesce(expense, expense_factor, 1.0::DOUBLE) AS expense_factor
FROM (SELECT 'req-' || c_custkey AS request_id,
             CASE c_custkey % 10 WHEN 0 THEN 'best' WHEN 1 THEN NULL ELSE 'plan-' || c_custkey % 500 END AS scenario FROM customer) r
LEFT JOIN stored_factors s ON s.scenario = r.scenario LEFT JOIN factors f ON f.scenario = r.scenario""")
register("weekly_forecast_stored_scenarios",
         lambda t: forecast.weekly_forecast(
             t.actual_ledger, t.recurring_items, t.debt_schedule(AS_OF), AS_OF, WEEKS, PLANS,
             forecast.seasonal_baseline(t.actual_ledger, AS_OF), stored_scenarios=t.scenarios, seasonal=True,
             by_frequency=True), f"""
SELECT week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
       'Operating Expenses' AS cash_flow_category, 'Week ' || week_number || ' - OpEx (forecast)' AS description,
       0.0 - weekly_avg * expense_factor AS amount, scenario
FROM expense_row, weeks, {CHOSEN} UNION ALL
SELECT week_number, week_start, week_end, transaction_date,
       CASE WHEN contains(cash_flow_category, 'Debt') THEN 'Financing' ELSE 'Operating' END,
       cash_flow_category, description || ' (recurring)', amount, scenario
FROM item_days, {CHOSEN} WHERE end_date IS NULL OR end_date >= DATE '{{AS_OF}}' UNION ALL
SELECT week_number, week_start, week_end, payment_date, 'Financing', 'Debt Service', loan_name || ' - ' || lender,
       0.0 - payment_amount, scenario
FROM due_debt JOIN weeks ON payment_date BETWEEN week_start AND week_end, {CHOSEN} UNION ALL
""" + SEASONAL_SQL.replace("{factors}", f"(SELECT scenario, revenue_factor AS factor FROM {CHOSEN})"))
register("forecast_debt_lines",
         lambda t: forecast.forecast_debt_lines(
             forecast.upcoming_debt(t.debt_schedule(AS_OF), AS_OF), *SPAN),
         "SELECT * FROM debt_lines")
register("weekly_forecast", planned_lines, "SELECT * FROM lines")
register("cash_position_runway",
         lambda t: forecast.cash_position_runway(planned_lines(t), START_BALANCE), """
SELECT scenario, week_number, week_start, week_end, CAST(net AS DOUBLE) AS net_cash_flow,
       CAST(balance AS DOUBLE) AS cash_balance,
       MIN(CASE WHEN balance < 0 THEN week_number END) OVER (PARTITION BY scenario) AS runway_weeks
FROM week_balances""")
register("runway_by_scenario",
         lambda t: forecast.runway_by_scenario(
             forecast.weekly_position(planned_lines(t), START_BALANCE)),
         """SELECT scenario, MIN(CASE WHEN balance < 0 THEN week_number END) AS runway_weeks
            FROM week_balances GROUP BY scenario""")
register("forecast_to_ledger",
         lambda t: forecast.forecast_to_ledger(planned_lines(t), ids="hash").drop("created_at", "updated_at"), """
SELECT sha256(concat_ws('|', scenario, CAST(transaction_date AS VARCHAR), cash_flow_category, description,
                        CAST(CAST(round_even(amount * 10000, 0) AS BIGINT) AS VARCHAR))) AS transaction_id,
       transaction_date, transaction_date AS cash_date, transaction_date AS value_date,
       'forecast' AS source_system, CAST(NULL AS VARCHAR) AS source_id, 'forecast_engine' AS source_table,
       'operating_checking' AS bank_account_id, 'Operating Checking' AS bank_account_name,
       cash_flow_section, cash_flow_category, CAST(NULL AS VARCHAR) AS cash_flow_subcategory, amount, 'USD' AS currency,
       CAST(NULL AS VARCHAR) AS counterparty, CAST(NULL AS VARCHAR) AS counterparty_type, description,
       CAST(NULL AS VARCHAR) AS notes, TRUE AS is_forecast, FALSE AS is_recurring, CAST(NULL AS VARCHAR) AS recurring_id,
       scenario AS scenario_id, CAST(NULL AS VARCHAR[]) AS tags, 'forecast_engine' AS created_by FROM lines""")
register("cash_forecast_rollup",
         lambda t: forecast.cash_forecast_rollup(planned_lines(t), START_BALANCE, AS_OF,
                                                 loc_balance=100000.0, loc_available=400000.0), """
SELECT 'forecast-{AS_OF}' AS forecast_id, DATE '{AS_OF}' AS forecast_date, week_end AS period_date,
       scenario AS scenario_id, CAST(week_number AS BIGINT) AS week_number, FALSE AS is_actual,
       CAST(op_in AS DOUBLE) AS operating_inflows, CAST(op_out AS DOUBLE) AS operating_outflows,
       CAST(op_in - op_out AS DOUBLE) AS operating_cash_flow, CAST(inv_out AS DOUBLE) AS investing_outflows,
       CAST(fin_in AS DOUBLE) AS financing_inflows, CAST(fin_out AS DOUBLE) AS financing_outflows,
       CAST(net AS DOUBLE) AS net_cash_flow, CAST(ending - net AS DOUBLE) AS beginning_cash,
       CAST(ending AS DOUBLE) AS ending_cash, CAST(100000.0 AS DOUBLE) AS loc_balance,
       CAST(400000.0 AS DOUBLE) AS loc_available, CAST(ending + 400000 AS DOUBLE) AS total_liquidity,
       CASE WHEN SUM(net) OVER w >= 0 THEN CAST(0.0 AS DOUBLE)
            ELSE abs(CAST(SUM(net) OVER w AS DOUBLE)) / COUNT(*) OVER w END AS avg_weekly_burn,
       CAST(MIN(CASE WHEN ending < 0 THEN week_number END) OVER w AS BIGINT) AS weeks_of_runway
FROM (SELECT *, 250000 + SUM(net) OVER (PARTITION BY scenario ORDER BY week_number) AS ending
      FROM (SELECT scenario, week_number, week_end,
                   SUM(CASE WHEN cash_flow_section = 'Operating' AND amount > 0 THEN exact ELSE 0 END) AS op_in,
                   SUM(CASE WHEN cash_flow_section = 'Operating' AND amount < 0 THEN -exact ELSE 0 END) AS op_out,
                   SUM(CASE WHEN cash_flow_section = 'Investing' AND amount < 0 THEN -exact ELSE 0 END) AS inv_out,
                   SUM(CASE WHEN cash_flow_section = 'Financing' AND amount > 0 THEN exact ELSE 0 END) AS fin_in,
                   SUM(CASE WHEN cash_flow_section = 'Financing' AND amount < 0 THEN -exact ELSE 0 END) AS fin_out,
                   SUM(exact) AS net FROM exact_lines GROUP BY ALL))
WINDOW w AS (PARTITION BY scenario)""")
