"""Operators the reference declares in its design or configuration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.operators import accounts, etl, timing, views
from tillflow.plans.registry import AS_OF, register
from tillflow.sources.adapters import TestTables

HOLIDAYS = ["1995-12-25", "1996-12-25", "1997-12-25", "1998-12-25", "1999-12-24", "2000-12-25"]


def _termed_lines(t: TestTables):
    return t.raw("lineitem").select(
        F.concat(F.lit("term-"), F.col("l_suppkey").cast("string")).alias("term_id"),
        F.to_date("l_shipdate").alias("transaction_date"), "l_orderkey", "l_linenumber",
        F.col("l_returnflag").alias("channel"))


PLAIN = """
SELECT 'term-' || l_suppkey AS term_id, CAST(l_shipdate AS DATE) AS transaction_date, l_orderkey, l_linenumber,
       l_returnflag AS channel, payment_timing, weekend_handling,
       CASE WHEN settlement_period_days IS NOT NULL
            THEN DATE '1970-01-01' + CAST((floor((CAST(l_shipdate AS DATE) - DATE '1970-01-01') / 14.0) + 1) * 14 - 1 AS INTEGER) + 2
            WHEN tuesday_friday THEN CAST(l_shipdate AS DATE) + 2
                 + CAST(least((9 - dayofweek(CAST(l_shipdate AS DATE) + 2)) % 7, (12 - dayofweek(CAST(l_shipdate AS DATE) + 2)) % 7) AS INTEGER)
            WHEN month_end THEN last_day(CAST(l_shipdate AS DATE) + 30)
            ELSE CAST(l_shipdate AS DATE) + CAST(coalesce(lag_days, other_lag) AS INTEGER) END AS plain
FROM lineitem JOIN payment_rules ON term_id = 'term-' || l_suppkey"""
ROLLED = f"""
SELECT term_id, transaction_date, l_orderkey, l_linenumber, channel, payment_timing, weekend_handling,
       CASE WHEN weekend_handling = 'Next Business Day' AND dayofweek(plain) = 6 THEN plain + 2
            WHEN weekend_handling = 'Next Business Day' AND dayofweek(plain) = 0 THEN plain + 1
            WHEN weekend_handling = 'Previous Business Day' AND dayofweek(plain) = 6 THEN plain - 1
            WHEN weekend_handling = 'Previous Business Day' AND dayofweek(plain) = 0 THEN plain - 2
            ELSE plain END AS cash_date
FROM ({PLAIN})"""

# Rules that pay with a settlement or payout take its date; others, and rows after the
# last known event, keep the rule's own.
register("apply_payment_timing",
         lambda t: timing.apply_payment_timing(_termed_lines(t), t.payment_terms, events=t.channel_events), f"""
SELECT term_id, transaction_date, l_orderkey, l_linenumber, r.channel, coalesce(e.event_date, cash_date) AS cash_date
FROM (SELECT *, CASE payment_timing WHEN 'with_settlement' THEN 'settlement' WHEN 'with_payout' THEN 'payout' END AS kind
      FROM ({ROLLED})) r
ASOF LEFT JOIN (SELECT DISTINCT channel, event_kind, event_date FROM channel_events) e
  ON r.channel = e.channel AND r.kind = e.event_kind AND r.transaction_date <= e.event_date""")
register("apply_payment_timing_holidays",
         lambda t: timing.apply_payment_timing(
             _termed_lines(t), t.payment_terms,
             holidays=t.spark.createDataFrame([(h,) for h in HOLIDAYS], "holiday string")
                       .select(F.to_date("holiday").alias("holiday"))), f"""
SELECT term_id, transaction_date, l_orderkey, l_linenumber, channel,
       CASE WHEN weekend_handling <> 'Next Business Day' OR cash_date IS NULL THEN cash_date
            WHEN cash_date NOT IN ({', '.join(f"DATE '{h}'" for h in HOLIDAYS)}) THEN cash_date
            WHEN dayofweek(cash_date) = 5 THEN cash_date + 3 ELSE cash_date + 1 END AS cash_date
FROM ({ROLLED})""")
register("seasonal_revenue",
         lambda t: timing.seasonal_revenue(
             t.sku_forecast.select("month", "sku", "platform", "forecast_revenue"),
             "month", "forecast_revenue"), """
SELECT month, sku, platform, CAST(forecast_revenue AS DOUBLE) AS forecast_revenue, seasonal_factor,
       CAST(CAST(forecast_revenue * CAST(seasonal_factor AS DECIMAL(4,1)) AS DECIMAL(18,4)) AS DOUBLE) AS seasonal_amount
FROM (SELECT *, CAST(CASE WHEN month(month) IN (10, 11, 12) THEN 2.5 WHEN month(month) IN (1, 2, 3) THEN 0.6
                          ELSE 1.0 END AS DOUBLE) AS seasonal_factor FROM sku_forecast)""")
register("payout_settlement", lambda t: timing.payout_settlement(t.payout_lines), """
SELECT payout_id, payout_date, COUNT(*) AS charge_count, CAST(SUM(value_amount) AS DOUBLE) AS gross_amount,
       CAST(SUM(fee_amount) AS DOUBLE) AS fee_amount, CAST(SUM(net_amount) AS DOUBLE) AS net_amount,
       MIN(CAST(transaction_time AS DATE)) AS first_charge, MAX(CAST(transaction_time AS DATE)) AS last_charge,
       CAST(payout_date - MAX(CAST(transaction_time AS DATE)) AS INTEGER) AS lag_days,
       CAST(payout_date - MIN(CAST(transaction_time AS DATE)) AS INTEGER) AS max_lag_days
FROM payouts GROUP BY payout_id, payout_date""")

# Fees of every sales line, dated with the next settlement of their platform.
register("fee_dates_with_settlement",
         lambda t: timing.next_event(
             t.fees.select(F.col("platform").alias("channel"), F.to_date("date_time").alias("fee_date")),
             timing.settlement_events(etl.settle_deposits(t.deposits)), ["channel"], "fee_date"), """
SELECT f.channel, f.fee_date, e.cash_date AS next_event
FROM (SELECT DISTINCT platform AS channel, CAST(date_time AS DATE) AS fee_date FROM fees) f
ASOF LEFT JOIN (SELECT DISTINCT platform, cash_date FROM settled_deposits) e
  ON f.channel = e.platform AND f.fee_date <= e.cash_date""")

# A rule row as the accounts see it: the outflow rule wins unless only the
# inflow rule exists.
RULE_FIELDS = ["section", "category", "subcategory", "cash_timing", "is_cash"]
register("category_map", lambda t: accounts.category_rules(t.category_map).select(
    "leaf", "number", *[F.col(f"{side}_rule.{c}").alias(f"{side}_{c}") for side in ("in", "out") for c in RULE_FIELDS]), """
SELECT leaf, number, {}, {}
FROM rule_rows""".format(*[", ".join(f"CASE WHEN has_{side} THEN {'out_category' if (side, c) == ('out', 'category') else c} END AS {side}_{c}"
                                     for c in RULE_FIELDS) for side in ("in", "out")]))
register("map_accounts", lambda t: accounts.map_accounts(t.chart_of_accounts, t.category_map), """
SELECT account_number, full_name, chart.leaf AS account_name,
       CAST(len(string_split(full_name, ':')) AS BIGINT) AS account_level, parent_name, account_type,
       section AS cash_flow_section, CASE WHEN has_out THEN out_category ELSE category END AS cash_flow_category,
       subcategory AS cash_flow_subcategory, cash_timing AS default_payment_timing,
       CASE WHEN has_in THEN category END AS inflow_category, coalesce(is_cash, TRUE) AS is_cash_account
FROM chart LEFT JOIN rule_rows ON rule_rows.leaf = chart.leaf""")
GL = """
SELECT sha256(concat_ws('|', 'gl', entry_id, CAST(transaction_date AS VARCHAR), account_name,
                        CAST(CAST(amount * 10000 AS BIGINT) AS VARCHAR))) AS transaction_id,
       transaction_date, transaction_date AS cash_date, transaction_date AS value_date, 'gl' AS source_system,
       entry_id AS source_id, 'gl_transactions' AS source_table, 'operating_checking' AS bank_account_id,
       'Operating Checking' AS bank_account_name, coalesce(section, 'Unclassified') AS cash_flow_section,
       coalesce(CASE WHEN amount < 0 AND has_in THEN category WHEN amount < 0 THEN out_category
                     WHEN has_out THEN out_category ELSE category END, 'Unclassified') AS cash_flow_category,
       subcategory AS cash_flow_subcategory, CAST(-amount AS DOUBLE) AS amount, 'USD' AS currency, vendor AS counterparty,
       CASE WHEN vendor IS NOT NULL THEN 'Vendor' END AS counterparty_type, 'Journal Entry' AS description,
       CAST(NULL AS VARCHAR) AS notes, FALSE AS is_forecast, FALSE AS is_recurring, CAST(NULL AS VARCHAR) AS recurring_id,
       CAST(NULL AS VARCHAR) AS scenario_id, CAST(NULL AS VARCHAR[]) AS tags, 'etl_gl' AS created_by
FROM gl LEFT JOIN rule_rows ON leaf = account_name WHERE coalesce(is_cash, TRUE)"""
register("gl_to_ledger",
         lambda t: accounts.gl_to_ledger(t.gl_transactions, t.category_map, ids="hash").drop("created_at", "updated_at"), GL)


def _accounts(t: TestTables):
    """One account per supplier, every third a credit line."""
    key = F.col("s_suppkey")
    return t.raw("supplier").select(
        F.concat(F.lit("acct-"), F.col("s_name")).alias("account_id"),
        F.when(key % 3 == 0, "LOC").otherwise("Checking").alias("account_type"),
        F.col("s_acctbal").alias("opening_balance"),
        F.when(key % 3 == 0, F.lit(500000.0)).alias("credit_limit"))


def _ledger_by_account(t: TestTables):
    return t.ledger.withColumn("bank_account_id", F.concat(F.lit("acct-"), F.col("counterparty")))


BALANCES = """
SELECT day AS balance_date, flows.bank_account_id, account_type,
       CAST(opening + so_far - CASE WHEN active THEN net ELSE 0 END AS DOUBLE) AS beginning_balance,
       CAST(opening + so_far AS DOUBLE) AS ending_balance,
       CAST(CASE WHEN active THEN inflow ELSE 0 END AS DOUBLE) AS total_inflows,
       CAST(CASE WHEN active THEN outflow ELSE 0 END AS DOUBLE) AS total_outflows,
       CAST(CASE WHEN active THEN net ELSE 0 END AS DOUBLE) AS net_change,
       CASE WHEN account_type = 'LOC' THEN CAST(500000 AS DOUBLE) END AS credit_limit,
       CASE WHEN account_type = 'LOC' THEN CAST(500000 - (opening + so_far) AS DOUBLE) END AS available_credit
FROM (SELECT f.*, d.day = f.cash_date AS active, CAST(d.day AS DATE) AS day,
             CASE WHEN s_suppkey % 3 = 0 THEN 'LOC' WHEN s_suppkey IS NOT NULL THEN 'Checking' END AS account_type,
             coalesce(CAST(s_acctbal AS DECIMAL(18,4)), 0) AS opening
      FROM (SELECT CAST(unnest(generate_series((SELECT min(cash_date) FROM actuals), (SELECT max(cash_date) FROM actuals),
                                               INTERVAL 1 DAY)) AS DATE) AS day) d
      JOIN (SELECT *, SUM(net) OVER account AS so_far,
                   lead(cash_date, 1, DATE '9999-12-31') OVER account AS following
            FROM (SELECT 'acct-' || counterparty AS bank_account_id, cash_date, SUM(amount) AS net,
                         SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS inflow,
                         SUM(CASE WHEN amount < 0 THEN abs(amount) ELSE 0 END) AS outflow
                  FROM actuals GROUP BY ALL)
            WINDOW account AS (PARTITION BY bank_account_id ORDER BY cash_date)) f
        ON d.day >= f.cash_date AND d.day < f.following
      LEFT JOIN supplier ON 'acct-' || s_name = f.bank_account_id) flows"""
register("daily_balances",
         lambda t: accounts.daily_balances(_ledger_by_account(t), _accounts(t)), BALANCES)
# Both operators in a chain: idle accounts still count on the last day.
register("position_of_daily_balances",
         lambda t: views.cash_position(accounts.daily_balances(_ledger_by_account(t), _accounts(t))
                                       .withColumn("is_forecast", F.lit(False))), f"""
SELECT CAST(cash AS DOUBLE) AS total_cash, CAST(drawn AS DOUBLE) AS total_loc_balance,
       CAST(available AS DOUBLE) AS total_loc_available, CAST(cash + available AS DOUBLE) AS total_liquidity
FROM (SELECT coalesce(SUM(CASE WHEN account_type = 'Checking' THEN e END), 0) AS cash,
             coalesce(SUM(CASE WHEN account_type = 'LOC' THEN abs(e) END), 0) AS drawn,
             coalesce(SUM(CASE WHEN account_type = 'LOC' THEN a END), 0) AS available
      FROM (SELECT account_type, CAST(ending_balance AS DECIMAL(18,4)) AS e, CAST(available_credit AS DECIMAL(18,4)) AS a
            FROM ({BALANCES}) WHERE balance_date = (SELECT max(cash_date) FROM actuals)))""")

register("budget_variance", lambda t: accounts.budget_variance(t.budget, t.ledger), """
SELECT coalesce(b.period_type, a.period_type) AS period_type,
       coalesce(b.period_start_date, a.period_start_date) AS period_start_date,
       coalesce(b.cash_flow_section, a.cash_flow_section) AS cash_flow_section,
       coalesce(b.cash_flow_category, a.cash_flow_category) AS cash_flow_category, CAST(version AS BIGINT) AS version,
       CAST(budget_amount AS DOUBLE) AS budget_amount, CAST(actual AS DOUBLE) AS actual_amount,
       CAST(coalesce(actual, 0) - coalesce(budget_amount, 0) AS DOUBLE) AS variance_amount,
       CASE WHEN budget_amount <> 0
            THEN CAST(coalesce(actual, 0) - budget_amount AS DOUBLE) / CAST(abs(budget_amount) AS DOUBLE) * 100
       END AS variance_pct
FROM budget_rows b FULL OUTER JOIN actual_periods a
  ON b.period_type = a.period_type AND b.period_start_date = a.period_start_date
     AND b.cash_flow_section = a.cash_flow_section AND b.cash_flow_category = a.cash_flow_category""")

# Forecast rows have no vendor: they are dealt over the accounts of a few suppliers.
def _planned_by_account(t: TestTables):
    key = F.concat(F.lit("acct-Supplier#"), F.lpad((F.substring("transaction_id", 6, 20).cast("bigint") % 7).cast("string"), 9, "0"))
    return _ledger_by_account(t).withColumn(
        "bank_account_id", F.when(F.col("is_forecast"), key).otherwise(F.col("bank_account_id")))


register("scenario_balances",
         lambda t: accounts.scenario_balances(_planned_by_account(t), _accounts(t), AS_OF), """
SELECT * FROM (WITH last_day AS (SELECT DATE '{AS_OF}' - 1 AS last),
known AS (SELECT * FROM actuals WHERE cash_date < DATE '{AS_OF}'),
future AS (
  SELECT scenario_id, 'acct-Supplier#' || lpad(CAST(CAST(substr(transaction_id, 6) AS BIGINT) % 7 AS VARCHAR), 9, '0') AS account,
         cash_date, amount FROM planned, last_day WHERE cash_date > last),
closings AS (SELECT 'acct-' || counterparty AS account, SUM(amount) AS moved FROM known GROUP BY ALL),
held AS (SELECT DISTINCT scenario_id, c.account FROM closings c, future),
spans AS (
  SELECT scenario_id, account, CAST(last + 1 AS DATE) AS first FROM held, last_day UNION ALL
  SELECT scenario_id, account, min(cash_date) FROM future WHERE account NOT IN (SELECT account FROM closings WHERE account IS NOT NULL) GROUP BY ALL),
days AS (
  SELECT scenario_id, account, CAST(unnest(generate_series(first, (SELECT max(cash_date) FROM future), INTERVAL 1 DAY)) AS DATE) AS day
  FROM spans),
flows AS (
  SELECT scenario_id, account, cash_date, SUM(amount) AS net, SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS inflow,
         SUM(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS outflow FROM future GROUP BY ALL),
chained AS (
  SELECT d.scenario_id, d.account, day, coalesce(net, 0) AS net, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow,
         coalesce(moved, 0) + coalesce(CAST(s_acctbal AS DECIMAL(18,4)), 0)
           + SUM(coalesce(net, 0)) OVER (PARTITION BY d.scenario_id, d.account ORDER BY day) AS ending,
         CASE WHEN s_suppkey % 3 = 0 THEN 'LOC' WHEN s_suppkey IS NOT NULL THEN 'Checking' END AS account_type
  FROM days d LEFT JOIN flows f ON f.scenario_id = d.scenario_id AND f.account IS NOT DISTINCT FROM d.account AND f.cash_date = day
  LEFT JOIN closings c ON c.account IS NOT DISTINCT FROM d.account LEFT JOIN supplier ON 'acct-' || s_name = d.account)
SELECT day AS balance_date, account AS bank_account_id, account_type, CAST(ending - net AS DOUBLE) AS beginning_balance,
       CAST(ending AS DOUBLE) AS ending_balance, CAST(inflow AS DOUBLE) AS total_inflows,
       CAST(outflow AS DOUBLE) AS total_outflows, CAST(net AS DOUBLE) AS net_change,
       CASE WHEN account_type = 'LOC' THEN CAST(500000 AS DOUBLE) END AS credit_limit,
       CASE WHEN account_type = 'LOC' THEN CAST(500000 - ending AS DOUBLE) END AS available_credit,
       TRUE AS is_forecast, scenario_id
FROM chained)""")
# The days up to mid-1998 from the older rows alone, then brought up to date.
register("updated_daily_balances",
         lambda t: accounts.updated_daily_balances(
             accounts.daily_balances(_ledger_by_account(t).where("cash_date < DATE'1998-07-01'"), _accounts(t)),
             _ledger_by_account(t), _accounts(t), "1998-07-01"), BALANCES)
