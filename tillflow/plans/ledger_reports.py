"""Views and reports over the ledger, and maintenance of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.functions.money import units
from tillflow.operators import etl, forecast, views
from tillflow.plans.registry import AS_OF, SCENARIOS, register
from tillflow.sources import sinks
from tillflow.sources.adapters import TestTables

IN_OUT = """CAST(SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DOUBLE) AS {i},
       CAST(SUM(CASE WHEN amount < 0 THEN abs(amount) ELSE 0 END) AS DOUBLE) AS {o},
       CAST(SUM(amount) AS DOUBLE) AS net_cash_flow"""

register("v_daily_cash_flow", lambda t: views.daily_cash_flow(t.ledger), f"""
SELECT cash_date, cash_flow_section, cash_flow_category, cash_flow_subcategory,
       {IN_OUT.format(i='total_inflows', o='total_outflows')}, COUNT(*) AS transaction_count
FROM ledger WHERE NOT is_forecast GROUP BY 1, 2, 3, 4""")
register("v_weekly_cash_flow", lambda t: views.weekly_cash_flow(t.ledger, AS_OF), """
SELECT CAST(date_trunc('week', cash_date) AS DATE) AS week_start,
       CAST(date_trunc('week', cash_date) AS DATE) + 6 AS week_end, cash_flow_section, cash_flow_category,
       CAST(SUM(amount) AS DOUBLE) AS net_cash_flow, COUNT(*) AS transaction_count
FROM ledger WHERE NOT is_forecast AND cash_date >= DATE '{AS_OF}' - 91 GROUP BY ALL""")
register("v_cash_position", lambda t: views.cash_position(t.cash_balances), """
SELECT CAST(total_cash AS DOUBLE) AS total_cash, CAST(total_loc_balance AS DOUBLE) AS total_loc_balance,
       CAST(total_loc_available AS DOUBLE) AS total_loc_available,
       CAST(total_liquidity AS DOUBLE) AS total_liquidity FROM position""")
register("direction_summary", lambda t: views.direction_summary(t.ledger), """
SELECT cash_flow_section, CASE WHEN amount > 0 THEN 'Inflow' ELSE 'Outflow' END AS direction,
       COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM ledger GROUP BY 1, 2""")
register("daily_in_out", lambda t: views.daily_in_out(t.ledger), f"""
SELECT cash_date, {IN_OUT.format(i='inflows', o='outflows')}
FROM ledger GROUP BY cash_date ORDER BY cash_date DESC LIMIT 30""")
register("top_revenue_days", lambda t: views.top_revenue_days(t.ledger), """
SELECT cash_date, cash_flow_category, CAST(SUM(amount) AS DOUBLE) AS revenue
FROM ledger WHERE amount > 0 GROUP BY 1, 2
ORDER BY SUM(amount) DESC, cash_date, cash_flow_category LIMIT 20""")
register("recent_ledger", lambda t: views.recent_ledger(t.ledger), """
SELECT cash_date, cash_flow_section, cash_flow_category, counterparty, CAST(amount AS DOUBLE) AS amount,
       description FROM ledger ORDER BY cash_date DESC, transaction_id LIMIT 50""")
register("category_last_30d", lambda t: views.category_last_days(t.ledger, AS_OF), """
SELECT cash_date, cash_flow_category, CAST(SUM(amount) AS DOUBLE) AS net_cash_flow
FROM ledger WHERE cash_date >= DATE '{AS_OF}' - 30 AND NOT is_forecast GROUP BY 1, 2""")
register("revenue_check", lambda t: views.revenue_check(t.ledger), """
SELECT cash_date, cash_flow_category, COUNT(*) AS count, CAST(SUM(amount) AS DOUBLE) AS total_revenue
FROM ledger WHERE cash_flow_section = 'Operating' AND cash_flow_category LIKE 'Revenue%'
GROUP BY 1, 2 ORDER BY cash_date DESC, cash_flow_category LIMIT 20""")
register("vendor_outflow_check", lambda t: views.vendor_outflow_check(t.ledger), """
SELECT cash_date, counterparty, COUNT(*) AS count, CAST(SUM(amount) AS DOUBLE) AS total_payments
FROM ledger WHERE cash_flow_section = 'Operating' AND amount < 0
GROUP BY 1, 2 ORDER BY cash_date DESC, counterparty LIMIT 20""")
register("account_limits", lambda t: views.account_limits(t.bank_accounts), """
SELECT c_name AS account_name,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Checking' WHEN 'BUILDING' THEN 'Money Market'
            WHEN 'FURNITURE' THEN 'LOC' WHEN 'HOUSEHOLD' THEN 'Credit Card' ELSE 'Savings' END AS account_type,
       'Bank ' || c_nationkey AS institution_name,
       CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN abs(c_acctbal) END AS "limit"
FROM customer""")
register("active_recurring_by_size", lambda t: views.active_recurring_by_size(t.recurring_transactions),
         "SELECT transaction_name, amount, frequency, day_of_month FROM recurring WHERE is_active")
register("terms_listing", lambda t: views.terms_listing(t.payment_terms),
         "SELECT term_name, cycle_type, lag_days FROM payment_rules")
register("scenario_listing", lambda t: views.scenario_listing(t.scenarios), """
SELECT 'Plan ' || s_name AS scenario_name,
       CASE s_suppkey % 4 WHEN 0 THEN 'Base' WHEN 1 THEN 'Best' WHEN 2 THEN 'Worst' ELSE 'Custom' END
         AS scenario_type, s_acctbal / 100000.0 AS revenue_growth_rate FROM supplier""")

# ---- maintenance ------------------------------------------------------------

# The two audit times differ from run to run.
TIMES = ["created_at", "updated_at"]
WHOLE = "* REPLACE (CAST(amount AS DOUBLE) AS amount)"


def _replacement(t: TestTables):
    """The base scenario's rows, raised by a tenth."""
    rows = t.planned_ledger.where("scenario_id = 'base'")
    return etl.as_ledger(rows.withColumn("amount", units("amount") * 11 / 100000.0))


register("append_ledger", lambda t: sinks.arrange_ledger(t.ledger).drop(*TIMES), f"""
SELECT {WHOLE}, coalesce('of ' || scenario_id, 'none') AS scenario,
       CASE WHEN is_forecast THEN 'forecast' ELSE strftime(cash_date, '%Y-%m') END AS slice FROM ledger_full""")
register("replace_scenario",
         lambda t: sinks.replaced_scenario(t.ledger, _replacement(t), "base").drop(*TIMES), f"""
SELECT {WHOLE} FROM ledger_full WHERE NOT is_forecast OR scenario_id <> 'base' UNION ALL
SELECT {WHOLE.replace("CAST(amount", "CAST(amount * 1.1")}
FROM ledger_full WHERE is_forecast AND scenario_id = 'base'""")
register("insert_rows_ignore_duplicates",
         lambda t: sinks.new_rows(t.actual_ledger, t.actual_ledger.where("source_system = 'deposits'"),
                                  ["transaction_id"]).drop(*TIMES),
         f"""SELECT DISTINCT {WHOLE} FROM invoice_rows
            WHERE transaction_id NOT IN (SELECT transaction_id FROM deposit_rows)""")
register("delete_loan",
         lambda t: sinks.without_loan(t.debt_schedule(AS_OF), "loan-7"),
         "SELECT * FROM schedule WHERE loan_id <> 'loan-7'")


def _forecast_runs(t: TestTables):
    """A forecast table with an older and a newer run; they differ in cash."""
    run = forecast.cash_forecast_rollup(planned_lines(t), 250000.0, AS_OF)
    runs = run.withColumn("forecast_id", F.explode(F.array(F.lit("run-1"), F.lit("run-2"))))
    return runs.withColumn("ending_cash", F.when(F.col("forecast_id") == "run-1", 0.0)
                           .otherwise(F.col("ending_cash")))


def planned_lines(t: TestTables):
    return forecast.weekly_forecast(t.actual_ledger, t.recurring_transactions,
                                    t.debt_schedule(AS_OF), AS_OF, 13, SCENARIOS, 75000.0)


register("latest_forecast", lambda t: views.latest_forecast(_forecast_runs(t)), """
SELECT week_end AS week_ending, CAST(week_number AS BIGINT) AS week_number,
       CAST(operating AS DOUBLE) AS operating_cash_flow, CAST(balance AS DOUBLE) AS ending_cash,
       CAST(balance AS DOUBLE) AS total_liquidity,
       CAST(MIN(CASE WHEN balance < 0 THEN week_number END) OVER () AS BIGINT) AS weeks_of_runway
FROM week_balances JOIN (SELECT week_number AS w, SUM(CASE WHEN cash_flow_section = 'Operating' THEN exact ELSE 0 END) AS operating
                         FROM exact_lines WHERE scenario = 'base' GROUP BY week_number) ON w = week_number
WHERE scenario = 'base'""")
