"""Dashboard metrics."""

from __future__ import annotations

from tillflow.operators import metrics, views
from tillflow.plans.registry import AS_OF, register
from tillflow.sources.adapters import TestTables


def _weekly(t: TestTables):
    return metrics.weekly_in_out(t.ledger, AS_OF)


def _position(t: TestTables):
    return views.cash_position(t.cash_balances)


def _balances(t: TestTables):
    return metrics.weekly_balance(_weekly(t), _position(t))


WEEK_OUT = """week_start, week_end, CAST(net AS DOUBLE) AS net_cash_flow,
       CAST(inflows AS DOUBLE) AS inflows, CAST(outflows AS DOUBLE) AS outflows"""
BURN = """CASE WHEN total_net >= 0 THEN CAST(0.0 AS DOUBLE)
       ELSE abs(CAST(total_net AS DOUBLE) / weeks) END AS burn_rate"""

register("scenario_ledger", lambda t: metrics.scenario_ledger(t.ledger, AS_OF), """
SELECT cash_date, cash_flow_section, cash_flow_category, CAST(amount AS DOUBLE) AS amount, is_forecast,
       scenario_id, description FROM chosen_rows""")
register("weekly_in_out", _weekly, f"SELECT {WEEK_OUT} FROM weeks_in_out")
register("weekly_balance", _balances,
         f"SELECT {WEEK_OUT}, CAST(cash_balance AS DOUBLE) AS cash_balance, week_index FROM balances")
register("weekly_balance_override",
         lambda t: metrics.weekly_balance(_weekly(t), _position(t), "1000.50"), f"""
SELECT {WEEK_OUT}, CAST(1000.5 + SUM(net) OVER (ORDER BY week_start) AS DOUBLE) AS cash_balance,
       CAST(row_number() OVER (ORDER BY week_start) AS INTEGER) AS week_index FROM weeks_in_out""")
register("runway", lambda t: metrics.runway(_balances(t)), "SELECT runway_weeks FROM summary")
register("burn_rate", lambda t: metrics.burn_rate(_balances(t)), f"SELECT {BURN} FROM summary")
register("risk_flags", lambda t: metrics.risk_flags(_balances(t)), """
SELECT unnest(CASE WHEN len(flags) > 0 THEN flags ELSE ['No high-priority risk flags'] END) AS risk_flag
FROM (SELECT list_filter([CASE WHEN runway_weeks < 4 THEN 'Runway under 4 weeks (' || runway_weeks || ' weeks)' END,
                          CASE WHEN runway_weeks IS NULL AND any_negative THEN 'One or more weeks show negative cash balance' END,
                          CASE WHEN last_balance < 0 THEN 'Ending cash balance is negative' END],
                         lambda x: x IS NOT NULL) AS flags FROM summary)""")
register("dashboard_kpis", lambda t: metrics.dashboard_kpis(_balances(t), _position(t)), f"""
SELECT (SELECT CAST(total_liquidity AS DOUBLE) FROM position) AS cash_position, runway_weeks, {BURN} FROM summary""")
register("scenario_comparison", lambda t: metrics.scenario_comparison(t.ledger, AS_OF, 250000.0), """
SELECT week_start, scenario_id, CAST(net AS DOUBLE) AS net_cash_flow,
       CAST(250000 + SUM(net) OVER (PARTITION BY scenario_id ORDER BY week_start) AS DOUBLE) AS cash_balance
FROM (SELECT CAST(date_trunc('week', cash_date) AS DATE) AS week_start, scenario_id, SUM(amount) AS net
      FROM ledger WHERE cash_date >= DATE '{AS_OF}' - 91 GROUP BY ALL)""")
register("scenario_table",
         lambda t: metrics.scenario_table(metrics.scenario_comparison(t.ledger, AS_OF, 250000.0),
                                          ["base", "best", "worst"]), """
SELECT week_start, MAX(CASE WHEN scenario_id IS NULL THEN balance END) AS actual,
       MAX(CASE WHEN scenario_id = 'base' THEN balance END) AS base,
       MAX(CASE WHEN scenario_id = 'best' THEN balance END) AS best,
       MAX(CASE WHEN scenario_id = 'worst' THEN balance END) AS worst
FROM (SELECT week_start, scenario_id,
             CAST(250000 + SUM(net) OVER (PARTITION BY scenario_id ORDER BY week_start) AS DOUBLE) AS balance
      FROM (SELECT CAST(date_trunc('week', cash_date) AS DATE) AS week_start, scenario_id, SUM(amount) AS net
            FROM ledger WHERE cash_date >= DATE '{AS_OF}' - 91 GROUP BY ALL))
GROUP BY week_start""")

WEEKLY_VIEW = """
SELECT CAST(date_trunc('week', cash_date) AS DATE) AS week_start, cash_flow_section, cash_flow_category,
       SUM(amount) AS net, COUNT(*) AS n
FROM ledger WHERE NOT is_forecast AND cash_date >= DATE '{AS_OF}' - 91 GROUP BY ALL"""
register("weekly_measures",
         lambda t: metrics.weekly_measures(views.weekly_cash_flow(t.ledger, AS_OF),
                                           ["cash_flow_section", "cash_flow_category"]), f"""
SELECT cash_flow_section, cash_flow_category, CAST(SUM(net) AS DOUBLE) AS total_net_cash_flow,
       CAST(SUM(n) AS BIGINT) AS total_transaction_count
FROM ({WEEKLY_VIEW}) GROUP BY ALL""")
register("weekly_row_key",
         lambda t: metrics.weekly_row_key(views.weekly_cash_flow(t.ledger, AS_OF)).select(
             "row_key", "net_cash_flow"), f"""
SELECT CAST(week_start AS VARCHAR) || '_' || coalesce(cash_flow_section, '') || '_'
         || coalesce(cash_flow_category, '') AS row_key, CAST(net AS DOUBLE) AS net_cash_flow
FROM ({WEEKLY_VIEW})""")
register("position_measures", lambda t: metrics.position_measures(_position(t)), """
SELECT CAST(total_cash AS DOUBLE) AS total_cash, CAST(total_liquidity AS DOUBLE) AS total_liquidity,
       CAST(total_loc_available AS DOUBLE) AS total_loc_available FROM position""")
register("cash_buffer_flags",
         lambda t: metrics.cash_buffer_flags(metrics.weekly_balance(
             metrics.weekly_in_out(t.ledger, AS_OF), _position(t), "-9000000")), f"""
SELECT *, CASE WHEN cash_balance < 50000 THEN 'below_minimum' WHEN cash_balance < 100000 THEN 'below_target'
               ELSE 'on_target' END AS buffer_status
FROM (SELECT {WEEK_OUT}, CAST(-9000000 + SUM(net) OVER (ORDER BY week_start) AS DOUBLE) AS cash_balance,
             CAST(row_number() OVER (ORDER BY week_start) AS INTEGER) AS week_index FROM weeks_in_out)""")
# The name it had while cash_buffer_flags read planned rows only.
register("cash_buffer_flags_ledger",
         lambda t: metrics.cash_buffer_flags(metrics.weekly_balance(
             metrics.weekly_in_out(t.ledger, AS_OF), _position(t), "-9000000")), f"""
SELECT *, CASE WHEN cash_balance < 50000 THEN 'below_minimum' WHEN cash_balance < 100000 THEN 'below_target'
               ELSE 'on_target' END AS buffer_status
FROM (SELECT {WEEK_OUT}, CAST(-9000000 + SUM(net) OVER (ORDER BY week_start) AS DOUBLE) AS cash_balance,
             CAST(row_number() OVER (ORDER BY week_start) AS INTEGER) AS week_index FROM weeks_in_out)""")
