"""The adapter tables once more, as SQL views for the oracle.

Written independently of the Spark adapters: money here is DECIMAL, there it
is whole ten-thousandths.  ``FIXTURES.md`` is the common definition.
"""

from __future__ import annotations

import re


def pay_date(months: str) -> str:
    """Date of the payment ``months`` after start, on the payment day."""
    month = f"CAST(date_trunc('month', start_date + to_months(CAST({months} AS INTEGER))) AS DATE)"
    return f"({month} + CAST(least(payment_day, day(last_day({month}))) - 1 AS INTEGER))"


def cents(column: str) -> str:
    size = f"floor(abs({column}) * 100 + 0.5) / 100"
    return f"(CASE WHEN {column} < 0 THEN -({size}) ELSE {size} END + 0.0)"


def money_text(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR)"


def _schedule_columns(kind: str) -> str:
    return f"""loan_id, loan_name, lender, payment_date, payment_number,
       {cents('payment')} AS payment_amount, {cents('principal')} AS principal_amount,
       {cents('interest')} AS interest_amount, CAST(0.0 AS DOUBLE) AS fees_amount,
       {cents('beginning')} AS beginning_principal, {cents('ending')} AS ending_principal,
       annual_rate AS interest_rate, 30 AS days_in_period, '{kind}' AS payment_type"""


LEVEL = """CASE WHEN {k} >= amort_months THEN CAST(0.0 AS DOUBLE)
       WHEN annual_rate = 0 THEN current_balance * (1 - CAST({k} AS DOUBLE) / amort_months)
       ELSE current_balance * ((pow(1 + annual_rate / 12, amort_months) - pow(1 + annual_rate / 12, {k}))
                               / (pow(1 + annual_rate / 12, amort_months) - 1)) END"""
FIXED = """CASE WHEN annual_rate = 0 THEN current_balance - fixed_payment * {k}
       ELSE current_balance * pow(1 + annual_rate / 12, {k})
            - fixed_payment * (pow(1 + annual_rate / 12, {k}) - 1) / (annual_rate / 12) END"""

PLATFORM = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Amazon' WHEN '2' THEN 'Shopify'
       WHEN '3' THEN 'TikTok' WHEN '4' THEN 'Wholesale' ELSE '{other}' END"""

LEAF = """upper(substr(split_part({name}, ' ', 1), 1, 1)) || lower(substr(split_part({name}, ' ', 1), 2))
       || ' ' || upper(substr(split_part({name}, ' ', 2), 1, 1)) || lower(substr(split_part({name}, ' ', 2), 2))
       || ' ' || CAST({key} AS VARCHAR)"""

ACCOUNT_TYPE = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Checking' WHEN 'BUILDING' THEN 'Money Market'
       WHEN 'FURNITURE' THEN 'LOC' WHEN 'HOUSEHOLD' THEN 'Credit Card' ELSE 'Savings' END"""

SUPPLIER = "'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"


def _settlement_rows(settled: str, source: str, category: str, subcategory: str, noun: str,
                     tags: str) -> str:
    return f"""
SELECT sha256(concat_ws('|', '{source}', platform, CAST(settlement_id AS VARCHAR))) AS transaction_id,
       settlement_end AS transaction_date, cash_date, cash_date AS value_date,
       '{source}' AS source_system, CAST(settlement_id AS VARCHAR) AS source_id,
       '{source}' AS source_table, 'operating_checking' AS bank_account_id,
       'Operating Checking' AS bank_account_name, 'Operating' AS cash_flow_section,
       {category} AS cash_flow_category, '{subcategory}' AS cash_flow_subcategory,
       net_cash_received AS amount, 'USD' AS currency, platform AS counterparty,
       'Platform' AS counterparty_type,
       platform || ' {noun} ' || settlement_id || ' (' || order_count || ' orders, '
         || CAST(units_sold AS BIGINT) || ' units)' AS description,
       'Gross: $' || {money_text('gross_product_sales')}
         || ', Fees: $' || {money_text('abs(platform_fees + fulfillment_fees + other_fees)')}
         || ', Net: $' || {money_text('net_cash_received')} AS notes,
       FALSE AS is_forecast, FALSE AS is_recurring, CAST(NULL AS VARCHAR) AS recurring_id,
       CAST(NULL AS VARCHAR) AS scenario_id, [platform, {tags}] AS tags,
       'etl_{source}' AS created_by
FROM {settled}"""


def _settled(table: str, where: str = "") -> str:
    return f"""
SELECT platform, settlement_id, MIN(CAST(date_time AS DATE)) AS settlement_start,
       MAX(CAST(date_time AS DATE)) AS settlement_end,
       CASE WHEN platform IN ('Amazon', 'Shopify', 'TikTok') THEN MAX(CAST(date_time AS DATE)) + 2
            ELSE MAX(CAST(date_time AS DATE)) END AS cash_date,
       SUM(product_sales) AS gross_product_sales, SUM(shipping_credits) AS gross_shipping,
       SUM(gift_wrap_credits) AS gross_gift_wrap, SUM(promotional_rebates) AS promotional_rebates,
       SUM(selling_fees) AS platform_fees, SUM(fba_fees) AS fulfillment_fees,
       SUM(other_transaction_fees) AS other_fees, SUM(total) AS net_cash_received,
       COUNT(DISTINCT order_id) AS order_count, SUM(quantity) AS units_sold
FROM {table} {where} GROUP BY platform, settlement_id HAVING SUM(total) <> 0"""


VIEWS: dict[str, str] = {
    "sales_lines": f"""
SELECT *, product_sales + shipping_credits + gift_wrap_credits + promotional_rebates
          + coalesce(selling_fees, 0) + fba_fees + other_transaction_fees AS total
FROM (SELECT {PLATFORM.format(other='Whiskey')} AS platform,
             l_shipdate AS date_time,
             CAST(year(l_shipdate) * 1000 + dayofyear(l_shipdate) // 14 AS BIGINT) AS settlement_id,
             CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku,
             CAST(l_quantity AS BIGINT) AS quantity,
             CAST(ext AS DECIMAL(18,4)) AS product_sales,
             CAST(ext * tax AS DECIMAL(18,4)) AS shipping_credits,
             CAST(CASE WHEN l_linenumber = 7 THEN 1.5 ELSE 0 END AS DECIMAL(18,4)) AS gift_wrap_credits,
             CAST(-ext * dis AS DECIMAL(18,4)) AS promotional_rebates,
             CAST(CASE WHEN l_linenumber <> 6 THEN -0.15 * ext END AS DECIMAL(18,4)) AS selling_fees,
             CAST(-0.05 * ext AS DECIMAL(18,4)) AS fba_fees,
             CAST(-0.30 AS DECIMAL(18,4)) AS other_transaction_fees,
             o_custkey AS customer_id, CAST(l_linenumber AS BIGINT) AS order_line_id,
             l_returnflag AS return_flag
      FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext,
                   CAST(l_discount AS DECIMAL(4,2)) AS dis, CAST(l_tax AS DECIMAL(4,2)) AS tax
            FROM lineitem) JOIN orders ON l_orderkey = o_orderkey)""",
    "deposits": "SELECT * FROM sales_lines WHERE return_flag <> 'R'",
    "refunds": """
SELECT platform, date_time, settlement_id, order_id, sku, quantity,
       -product_sales AS product_sales, -shipping_credits AS shipping_credits,
       -gift_wrap_credits AS gift_wrap_credits, -promotional_rebates AS promotional_rebates,
       -selling_fees AS selling_fees, -fba_fees AS fba_fees, customer_id, order_line_id, return_flag,
       -other_transaction_fees AS other_transaction_fees, -total AS total
FROM sales_lines WHERE return_flag = 'R'""",
    "fees": "SELECT * FROM sales_lines",
    "sku_forecast": """
SELECT CAST(date_trunc('month', date_time) AS DATE) AS month, sku, platform,
       CAST(SUM(quantity) AS BIGINT) AS forecast_units, SUM(product_sales) AS forecast_revenue
FROM sales_lines GROUP BY ALL""",
    "vendors": """
SELECT s_name AS "Name",
       CASE s_suppkey % 4 WHEN 0 THEN 'Net 30' WHEN 1 THEN 'Net 15' WHEN 2 THEN 'Net 60' END AS "Terms",
       CASE WHEN s_suppkey % 3 <> 0 THEN 10 + s_suppkey % 50 END AS "Actual Days",
       CASE WHEN s_suppkey % 6 <> 0 THEN CAST(30 AS BIGINT) END AS "Request Days"
FROM supplier WHERE s_suppkey % 10 <> 9""",
    "vendor_days": """
SELECT "Name" AS vendor_name, "Terms" AS payment_terms,
       CAST(coalesce("Actual Days", "Request Days", 30) AS INTEGER) AS known_days FROM vendors""",
    "item": """
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS product,
       CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_retailprice AS DECIMAL(12,2)) END AS item_price,
       CASE WHEN p_partkey % 25 <> 0 THEN 0.60 * CAST(p_retailprice AS DECIMAL(12,2)) END AS build_cost
FROM part""",
    "invoices": f"""
SELECT CASE WHEN l_linenumber <> 7 THEN concat_ws('-', l_orderkey, l_linenumber, l_partkey) END AS invoice_id,
       {SUPPLIER} AS vendor,
       CASE WHEN l_quantity <> 50 THEN CAST(l_shipdate AS DATE) END AS invoice_date,
       'INV-' || l_orderkey AS invoice_number,
       CASE WHEN l_returnflag = 'N' THEN 'PO-' || l_orderkey END AS po_number,
       ext AS subtotal, CAST(ext * tax AS DECIMAL(18,4)) AS sales_tax,
       CAST(CASE WHEN l_returnflag = 'R' THEN -(ext + ext * tax) ELSE ext + ext * tax END
            AS DECIMAL(18,4)) AS total
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext, CAST(l_tax AS DECIMAL(4,2)) AS tax
      FROM lineitem WHERE l_linestatus = 'F')""",
    "dated_invoices": """
SELECT i.*, d.payment_terms, coalesce(d.known_days, 30) AS payment_days,
       i.invoice_date + coalesce(d.known_days, 30) AS cash_date
FROM invoices i LEFT JOIN vendor_days d ON i.vendor = d.vendor_name""",
    "po_line_item": f"""
SELECT 'PO-' || l_orderkey AS po_no, CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Closed' ELSE 'Partial' END AS status,
       {SUPPLIER} AS vendor, CAST(l_partkey AS VARCHAR) AS sku,
       CAST(l_quantity AS BIGINT) AS qty_ordered,
       CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS BIGINT) WHEN 'R' THEN 5 END AS qty_received
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cash_balances": f"""
SELECT balance_date, 'acct-' || account_type AS bank_account_id, account_type,
       whole AS ending_balance,
       CASE WHEN account_type = 'LOC' THEN 500000 - whole END AS available_credit
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS balance_date,
             {ACCOUNT_TYPE} AS account_type, SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS whole
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)""",
    "position": """
SELECT SUM(CASE WHEN account_type IN ('Checking', 'Savings', 'Money Market') THEN ending_balance ELSE 0 END) AS total_cash,
       SUM(CASE WHEN account_type = 'LOC' THEN abs(ending_balance) ELSE 0 END) AS total_loc_balance,
       SUM(CASE WHEN account_type = 'LOC' THEN available_credit ELSE 0 END) AS total_loc_available,
       SUM(CASE WHEN account_type IN ('Checking', 'Savings', 'Money Market') THEN ending_balance ELSE 0 END)
         + SUM(CASE WHEN account_type = 'LOC' THEN available_credit ELSE 0 END) AS total_liquidity
FROM cash_balances WHERE balance_date = (SELECT MAX(balance_date) FROM cash_balances)""",
    "payment_rules": """
SELECT 'term-' || s_suppkey AS term_id, 'Terms of ' || s_name AS term_name,
       CASE s_suppkey % 6 WHEN 0 THEN 'settlement' WHEN 1 THEN 'daily' WHEN 3 THEN 'immediate'
            WHEN 4 THEN 'credit_card' ELSE 'net_terms' END AS cycle_type,
       CASE s_suppkey % 6 WHEN 1 THEN CAST(2 AS BIGINT) WHEN 2 THEN s_suppkey % 61 WHEN 3 THEN 0 WHEN 4 THEN 30 END AS lag_days,
       CASE WHEN s_suppkey % 12 = 5 THEN 15 END AS other_lag, s_suppkey % 6 = 1 AS tuesday_friday, s_suppkey % 12 = 4 AS month_end,
       CASE s_suppkey % 24 WHEN 11 THEN 'with_settlement' WHEN 6 THEN 'with_settlement' WHEN 23 THEN 'with_payout' ELSE 'own' END
         AS payment_timing,
       CASE WHEN s_suppkey % 6 = 0 THEN 14 END AS settlement_period_days,
       CASE s_suppkey % 3 WHEN 0 THEN 'Next Business Day' WHEN 1 THEN 'Previous Business Day'
            ELSE 'No Adjustment' END AS weekend_handling
FROM supplier""",
    "channel_events": """
SELECT l_returnflag AS channel, 'settlement' AS event_kind, MAX(CAST(l_shipdate AS DATE)) + 2 AS event_date
FROM lineitem GROUP BY l_returnflag, year(l_shipdate), dayofyear(l_shipdate) // 14 UNION ALL
SELECT channel, 'payout', CASE dayofweek(day) WHEN 6 THEN day + 2 WHEN 0 THEN day + 1 ELSE day END
FROM (SELECT l_returnflag AS channel, CAST(l_shipdate AS DATE) + 2 AS day FROM lineitem
      WHERE l_returnflag <> 'N' AND day(l_shipdate) % 5 = 0 AND month(l_shipdate) NOT IN (7, 8))""",
    "recurring": """
SELECT 'rec-' || s_suppkey AS recurring_id, 'Charge of ' || s_name AS transaction_name,
       CASE s_suppkey % 5 WHEN 0 THEN 'OpEx - Rent' WHEN 1 THEN 'OpEx - Software'
            WHEN 2 THEN 'Debt Service' WHEN 3 THEN 'Bank Loan Fees' ELSE 'OpEx - Insurance' END AS cash_flow_category,
       0.0 - abs(s_acctbal) AS amount, 'Monthly' AS frequency,
       CAST(1 AS BIGINT) AS recurrence_interval, 1 + s_suppkey % 31 AS day_of_month,
       DATE '1997-01-01' + CAST(s_suppkey % 700 AS INTEGER) AS start_date,
       CASE WHEN s_suppkey % 4 = 0 THEN DATE '1998-01-01' + CAST(s_suppkey % 365 AS INTEGER) END AS end_date,
       s_suppkey % 11 <> 0 AS is_active
FROM supplier""",
    "stored_factors": """
SELECT 'plan-' || s_suppkey AS scenario, CASE WHEN s_suppkey % 5 = 0 THEN 1.25 ELSE 1.0 + s_acctbal / 100000.0 END AS revenue,
       CASE WHEN s_suppkey % 6 <> 0 THEN 1.0 + (s_suppkey % 7)::DOUBLE / 100.0::DOUBLE END AS expense
FROM supplier WHERE s_suppkey % 9 <> 0""",
    "items": """
SELECT *, CASE WHEN kind = 'Weekly' AND week_day IS NOT NULL
               THEN start_date + CAST((week_day - isodow(start_date) + 7) % 7 AS INTEGER) ELSE start_date END AS day_anchor,
       CASE WHEN kind = 'Annually' AND year_month IS NOT NULL
            THEN date_trunc('month', start_date) + to_months(CAST((year_month - month(start_date) + 12) % 12 AS INTEGER))
            ELSE date_trunc('month', start_date) END AS month_anchor
FROM (SELECT 'Charge to ' || c_name AS description, 0.0 - abs(c_acctbal) AS amount,
             CASE c_custkey % 3 WHEN 0 THEN 'OpEx - Rent' WHEN 1 THEN 'Debt Service' ELSE 'OpEx - Insurance' END AS cash_flow_category,
             CASE c_custkey % 6 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Weekly' WHEN 3 THEN 'Quarterly' WHEN 4 THEN 'Annually' ELSE 'Monthly' END AS kind,
             CAST(1 + c_custkey // 6 % 3 AS INTEGER) AS every, CASE WHEN c_custkey % 4 <> 0 THEN 1 + c_custkey % 7 END AS week_day,
             CASE WHEN c_custkey % 7 <> 0 OR c_custkey % 6 IN (2, 5) THEN 1 + c_custkey % 31 END AS month_day,
             CASE WHEN c_custkey % 5 <> 0 THEN 1 + c_custkey % 12 END AS year_month,
             DATE '1996-01-01' + CAST(c_custkey % 900 AS INTEGER) AS start_date,
             CASE WHEN c_custkey % 8 = 0 THEN DATE '1998-07-10' + CAST(c_custkey % 60 AS INTEGER) END AS end_date
      FROM customer WHERE c_custkey % 11 <> 0)
WHERE start_date <= DATE '{AS_OF}'""",
    "item_days": """
SELECT week_number, week_start, week_end, d AS transaction_date, i.*
FROM (SELECT *, week_start + CAST(n AS INTEGER) AS d FROM weeks, range(0, 7) r(n)) calendar, items i
WHERE CASE WHEN kind IN ('Daily', 'Weekly')
           THEN d >= day_anchor AND d <= coalesce(end_date, d)
                AND (d - CAST(day_anchor AS DATE)) % (every * CASE kind WHEN 'Weekly' THEN 7 ELSE 1 END) = 0
           WHEN kind = 'Monthly' THEN day(d) = month_day AND datediff('month', start_date, d) % every = 0
           ELSE d >= start_date AND d <= coalesce(end_date, d) AND date_trunc('month', d) >= month_anchor
                AND datediff('month', month_anchor, d) % (every * CASE kind WHEN 'Quarterly' THEN 3 ELSE 12 END) = 0
                AND day(d) = least(coalesce(month_day, day(start_date)), day(last_day(d))) END""",
    "live_recurring": """
SELECT recurring_id, transaction_name AS description, amount, cash_flow_category, frequency,
       recurrence_interval, day_of_month, start_date, end_date
FROM recurring WHERE is_active AND start_date <= DATE '{AS_OF}'
  AND (end_date IS NULL OR end_date >= DATE '{AS_OF}')""",
    "loans": """
SELECT 'loan-' || c_custkey AS loan_id, 'Loan of ' || c_name AS loan_name,
       'Bank ' || c_nationkey AS lender, balance AS original_amount, balance AS current_balance,
       CAST(CASE c_custkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 0.0725 WHEN 2 THEN 0.1075 WHEN 3 THEN 0.116516
            WHEN 4 THEN 0.115 WHEN 5 THEN 0.065 WHEN 6 THEN 0.0499 ELSE 0.09 END AS DOUBLE) AS annual_rate,
       CAST(1 + c_custkey % 31 AS INTEGER) AS payment_day,
       start_date, CAST(start_date + INTERVAL 60 MONTH AS DATE) AS maturity_date,
       CASE c_custkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 3 THEN '4' ELSE '3' END AS structure_choice,
       CASE c_custkey % 5 WHEN 0 THEN 24 WHEN 4 THEN 6 ELSE 0 END AS io_months,
       CASE c_custkey % 5 WHEN 0 THEN 36 WHEN 1 THEN 60 ELSE 0 END AS amort_months,
       CASE WHEN c_custkey % 5 = 3 THEN floor(balance * 0.65) / 100
            WHEN c_custkey % 5 IN (2, 4) AND c_custkey % 7 = 0 THEN floor(balance * 0.4) / 100
            WHEN c_custkey % 5 IN (2, 4) THEN floor(balance * 2.5) / 100 END AS fixed_payment,
       CASE WHEN c_custkey % 5 = 3 THEN floor(balance * 90) / 100 END AS balloon_amount,
       CAST(start_date + INTERVAL 24 MONTH AS DATE) AS io_end_date
FROM (SELECT *, CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) * 10 + 5000 AS DOUBLE) AS balance,
             DATE '1995-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS start_date FROM customer)""",
    "interest_only": f"""
SELECT {_schedule_columns('Interest Only')}
FROM (SELECT *, current_balance * (annual_rate / 360) * 30 AS interest,
             current_balance * (annual_rate / 360) * 30 AS payment, CAST(0.0 AS DOUBLE) AS principal,
             current_balance AS beginning, current_balance AS ending,
             {pay_date('payment_number - 1')} AS payment_date
      FROM (SELECT *, CAST(unnest(range(1, io_months + 1)) AS INTEGER) AS payment_number FROM loans))""",
    "amortising": f"""
SELECT {_schedule_columns('Principal & Interest')}
FROM (SELECT *, level - interest AS cut, least(level - interest, beginning) AS principal,
             least(level - interest, beginning) + interest AS payment
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest,
                   CASE WHEN annual_rate = 0 THEN current_balance / amort_months
                        ELSE current_balance * ((annual_rate / 12) * pow(1 + annual_rate / 12, amort_months))
                             / (pow(1 + annual_rate / 12, amort_months) - 1) END AS level
            FROM (SELECT *, {LEVEL.format(k='step')} AS beginning, {LEVEL.format(k='(step + 1)')} AS ending,
                         CAST(io_months + step + 1 AS INTEGER) AS payment_number,
                         {pay_date('io_months + step')} AS payment_date
                  FROM (SELECT *, unnest(range(0, amort_months)) AS step FROM loans WHERE amort_months > 0))))""",
    "fixed_payment_rows": f"""
SELECT {_schedule_columns('Fixed Payment')}
FROM (SELECT *, least(fixed_payment - interest, beginning) AS principal,
             least(fixed_payment - interest, beginning) + interest AS payment,
             greatest(0.0, beginning - least(fixed_payment - interest, beginning)) AS ending
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest
            FROM (SELECT *, {FIXED.format(k='step')} AS beginning,
                         CAST(io_months + step + 1 AS INTEGER) AS payment_number,
                         {pay_date('io_months + step')} AS payment_date,
                         CASE WHEN step = 0 THEN start_date ELSE {pay_date('io_months + step - 1')} END AS previous
                  FROM (SELECT *, unnest(range(0, datediff('month', start_date, maturity_date) + 4)) AS step
                        FROM loans WHERE amort_months = 0 AND fixed_payment IS NOT NULL AND balloon_amount IS NULL))
            WHERE floor(beginning * 100 + 0.5) > 0 AND previous <= maturity_date))""",
    "balloon_dates": f"""
SELECT *, CAST(io_months + step + 1 AS INTEGER) AS payment_number, {pay_date('io_months + step')} AS payment_date
FROM (SELECT *, unnest(range(0, datediff('month', start_date, maturity_date) + 4)) AS step
      FROM loans WHERE amort_months = 0 AND balloon_amount IS NOT NULL)""",
    "balloon_regular": f"""
SELECT {_schedule_columns('Regular Payment')}
FROM (SELECT *, fixed_payment AS payment, fixed_payment - interest AS principal,
             greatest(0.0, beginning - (fixed_payment - interest)) AS ending
      FROM (SELECT *, beginning * (annual_rate / 360) * 30 AS interest
            FROM (SELECT *, greatest(0.0, {FIXED.format(k='step')}) AS beginning FROM balloon_dates
                  WHERE payment_date < maturity_date AND start_date < maturity_date)))""",
    "balloon_final": f"""
SELECT {_schedule_columns('Balloon Payment')}
FROM (SELECT *, maturity_date AS payment_date, CAST(io_months + made + 1 AS INTEGER) AS payment_number,
             balloon_amount AS payment, beginning AS principal,
             beginning * (annual_rate / 360) * 30 AS interest, CAST(0.0 AS DOUBLE) AS ending
      FROM (SELECT *, greatest(0.0, {FIXED.format(k='made')}) AS beginning
            FROM (SELECT l.*, coalesce(m.made, 0) AS made FROM loans l
                  LEFT JOIN (SELECT loan_id, count(*) AS made FROM balloon_dates
                             WHERE payment_date < maturity_date AND start_date < maturity_date
                             GROUP BY loan_id) m ON l.loan_id = m.loan_id
                  WHERE l.amort_months = 0 AND l.balloon_amount IS NOT NULL)))""",
    "schedule": """
SELECT *, payment_date < DATE '{AS_OF}' AS is_paid, payment_date >= DATE '{AS_OF}' AS is_forecast
FROM (SELECT * FROM interest_only UNION ALL SELECT * FROM amortising
      UNION ALL SELECT * FROM fixed_payment_rows UNION ALL SELECT * FROM balloon_regular
      UNION ALL SELECT * FROM balloon_final)""",
    "credit_lines": "SELECT *, (CAST(regexp_extract(loan_id, '[0-9]+') AS BIGINT) % 4)::DOUBLE / 100.0::DOUBLE AS spread FROM loans",
    "line_days": """
SELECT l.*, CAST(unnest(generate_series(start_date, CAST(io_end_date - 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
FROM credit_lines l WHERE start_date < io_end_date""",
    "line_moves": """
SELECT 'loan-' || o_custkey AS loan_id, CAST(o_orderdate AS DATE) AS moved,
       SUM(CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * CAST(floor(o_totalprice * 5 + 0.5) / 100 AS DECIMAL(18,4))) AS net
FROM orders GROUP BY ALL""",
    "rate_changes": """
SELECT CASE WHEN m % 2 = 0 THEN d ELSE d + 14 END AS effective, 0.05::DOUBLE + (m % 9)::DOUBLE / 400.0::DOUBLE AS base_rate
FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m, MIN(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY ALL)
WHERE m % 5 = 0""",
    "rate_months": """
SELECT CAST(month AS DATE) AS month, coalesce(
         (SELECT arg_max(base_rate, effective) FROM rate_changes WHERE effective <= month),
         (SELECT arg_min(base_rate, effective) FROM rate_changes)) AS base_rate
FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2010-12-01', INTERVAL 1 MONTH)) AS month)""",
    "line_balances": f"""
SELECT d.*, month(day) AS month_of, CAST(date_trunc('month', day) AS DATE) AS month,
       CAST(current_balance AS DECIMAL(18,4)) + SUM(coalesce(net, 0)) OVER (PARTITION BY d.loan_id ORDER BY day) AS owed,
       CASE WHEN day(day) < least(payment_day, day(last_day(day)))
            THEN CAST(date_trunc('month', day) AS DATE) + CAST(least(payment_day, day(last_day(day))) - 1 AS INTEGER)
            ELSE CAST(date_trunc('month', day + INTERVAL 1 MONTH) AS DATE)
                 + CAST(least(payment_day, day(last_day(CAST(date_trunc('month', day) AS DATE) + INTERVAL 1 MONTH))) - 1 AS INTEGER) END AS due
FROM line_days d LEFT JOIN line_moves m ON m.loan_id = d.loan_id AND m.moved = day""",
    "line_terms": """
SELECT loan_id, loan_name, lender, least(due, io_end_date) AS payment_date, b.month, base_rate + spread AS rate, due,
       SUM(greatest(owed, 0)) AS owed_days, arg_max(owed, day) AS held, MAX(day) AS last_day
FROM line_balances b JOIN rate_months r ON r.month = b.month GROUP BY ALL""",
    "line_payments": """
SELECT loan_id, loan_name, lender, payment_date, arg_max(held, last_day) AS held,
       arg_max(rate, last_day) FILTER (owed_days > 0) AS rate,
       list_reduce([0.0::DOUBLE] || list(CAST(owed_days AS DOUBLE) * (rate / 360) ORDER BY rate, CAST(owed_days AS DOUBLE) * (rate / 360))
                                    FILTER (owed_days > 0), lambda a, b: a + b) AS interest
FROM line_terms GROUP BY loan_id, loan_name, lender, payment_date HAVING SUM(owed_days) > 0""",
    "due_debt": """
SELECT payment_date, loan_name, lender, payment_amount, principal_amount, interest_amount
FROM schedule WHERE payment_date BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 91 AND NOT is_paid""",
    "chart": f"""
SELECT CASE WHEN p_partkey % 3 = 0 THEN CAST(4000 + p_partkey AS VARCHAR)
            WHEN p_partkey % 50 = 1 THEN 'Draws' END AS account_number,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand || ':' || leaf ELSE leaf END AS full_name,
       leaf, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS parent_name,
       CASE WHEN p_partkey % 4 = 0 THEN 'Income' ELSE 'Expenses' END AS account_type,
       'General' AS detail_type,
       CASE WHEN p_partkey % 6 = 0 THEN 'Ads, cards, and other' END AS description, 'USD' AS currency
FROM (SELECT *, {LEAF.format(name='p_name', key='p_partkey')} AS leaf FROM part)""",
    "rule_rows": f"""
SELECT leaf, CASE WHEN p_partkey % 3 = 0 THEN CAST(4000 + p_partkey AS VARCHAR) END AS number,
       CASE WHEN k IN (3) THEN 'Investing' WHEN k IN (4, 5) THEN 'Financing' WHEN k = 6 THEN 'Non-Cash'
            ELSE 'Operating' END AS section,
       'Category ' || p_size AS category, p_type AS subcategory,
       CASE WHEN k <> 6 THEN 'immediate' END AS cash_timing, k <> 6 AS is_cash,
       k IN (0, 4) AS has_in, k <> 0 AS has_out,
       CASE WHEN k = 4 THEN 'Category ' || p_size || ' repaid' ELSE 'Category ' || p_size END AS out_category
FROM (SELECT *, p_partkey % 8 AS k, {LEAF.format(name='p_name', key='p_partkey')} AS leaf
      FROM part WHERE p_partkey % 5 <> 4)""",
    "gl": f"""
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS entry_id,
       CAST(l_shipdate AS DATE) AS transaction_date,
       CASE WHEN l_partkey % 3 = 0 THEN CAST(4000 + l_partkey AS VARCHAR) END AS account_number,
       {LEAF.format(name='p_name', key='l_partkey')} AS account_name,
       CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,4))
            ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END AS amount,
       {SUPPLIER} AS vendor
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "budget_rows": f"""
SELECT period_type, period_start_date, 'Operating' AS cash_flow_section, cash_flow_category,
       CASE WHEN month(period_start_date) % 2 = 1 THEN 2 ELSE 1 END AS version,
       CASE WHEN month(period_start_date) % 2 = 1 THEN amount * 1.1 ELSE amount END AS budget_amount
FROM (SELECT unit AS period_type, CAST(CASE unit WHEN 'Monthly' THEN date_trunc('month', o_orderdate)
                  WHEN 'Quarterly' THEN date_trunc('quarter', o_orderdate) ELSE date_trunc('year', o_orderdate) END AS DATE)
               AS period_start_date,
             'Revenue - ' || {PLATFORM.format(other='Outlet')} AS cash_flow_category,
             SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS amount
      FROM orders, (VALUES ('Monthly'), ('Quarterly'), ('Annual')) u(unit) GROUP BY ALL)""",
    "actual_periods": """
SELECT unit AS period_type, CAST(CASE unit WHEN 'Monthly' THEN date_trunc('month', cash_date)
            WHEN 'Quarterly' THEN date_trunc('quarter', cash_date) ELSE date_trunc('year', cash_date) END AS DATE)
         AS period_start_date, cash_flow_section, cash_flow_category, SUM(amount) AS actual
FROM actuals, (VALUES ('Monthly'), ('Quarterly'), ('Annual')) u(unit) GROUP BY ALL""",
    "payouts": """
SELECT *, 'payout-' || payout_date AS payout_id, value_amount - fee_amount AS net_amount
FROM (SELECT ts AS transaction_time, event_id, value,
             CASE dayofweek(CAST(ts AS DATE) + 2) WHEN 6 THEN CAST(ts AS DATE) + 4
                  WHEN 0 THEN CAST(ts AS DATE) + 3 ELSE CAST(ts AS DATE) + 2 END AS payout_date,
             CAST(value AS DECIMAL(18,4)) AS value_amount,
             CAST(CAST(value AS DECIMAL(12,2)) * 0.03 AS DECIMAL(18,4)) AS fee_amount
      FROM events WHERE event_type = 'purchase')""",
    "settled_deposits": _settled("deposits"),
    "settled_refunds": _settled("refunds"),
    "settled_in_range": _settled("deposits", "WHERE CAST(date_time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'"),
    "settled_on_any_day": _settled(
        "deposits", "WHERE CAST(date_time AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"),
    "deposit_rows_in_range": _settlement_rows("settled_in_range", "deposits", "'Revenue - ' || platform",
                                              "Ecommerce Revenue", "Settlement", "'ecommerce', 'revenue'"),
    "deposit_rows": _settlement_rows("settled_deposits", "deposits", "'Revenue - ' || platform",
                                     "Ecommerce Revenue", "Settlement", "'ecommerce', 'revenue'"),
    "refund_rows": _settlement_rows("settled_refunds", "refunds", "'Revenue - Refunds'",
                                    "Contra-Revenue", "Refunds", "'ecommerce', 'refund'"),
    "invoice_rows": f"""
SELECT sha256(concat_ws('|', 'invoices', invoice_id, vendor, CAST(invoice_date AS VARCHAR),
                        CAST(CAST(total * 10000 AS BIGINT) AS VARCHAR))) AS transaction_id,
       invoice_date AS transaction_date, cash_date, cash_date AS value_date,
       'invoices' AS source_system, invoice_id AS source_id, 'invoices' AS source_table,
       'operating_checking' AS bank_account_id, 'Operating Checking' AS bank_account_name,
       'Operating' AS cash_flow_section, 'COGS - Materials' AS cash_flow_category,
       'Vendor Payments' AS cash_flow_subcategory, -total AS amount, 'USD' AS currency,
       vendor AS counterparty, 'Vendor' AS counterparty_type,
       'Invoice ' || invoice_number
         || CASE WHEN po_number IS NOT NULL THEN ' (PO: ' || po_number || ')' ELSE '' END AS description,
       'Payment terms: ' || coalesce(payment_terms, 'Net 30') || ', Due: ' || CAST(cash_date AS VARCHAR)
         || ', Subtotal: $' || {money_text('subtotal')} || ', Tax: $' || {money_text('sales_tax')} AS notes,
       FALSE AS is_forecast, FALSE AS is_recurring, CAST(NULL AS VARCHAR) AS recurring_id,
       CAST(NULL AS VARCHAR) AS scenario_id, ['vendor', 'expense', 'cogs'] AS tags,
       'etl_invoices' AS created_by
FROM dated_invoices WHERE total > 0 AND invoice_date IS NOT NULL AND invoice_id IS NOT NULL""",
    "actuals": """
SELECT transaction_id, cash_date, cash_flow_section, cash_flow_category, cash_flow_subcategory, amount,
       counterparty, description, is_forecast, scenario_id, bank_account_id
FROM deposit_rows UNION ALL
SELECT transaction_id, cash_date, cash_flow_section, cash_flow_category, cash_flow_subcategory, amount,
       counterparty, description, is_forecast, scenario_id, bank_account_id
FROM invoice_rows""",
    "planned": """
SELECT 'plan-' || o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) + 90 AS cash_date,
       'Operating' AS cash_flow_section,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Operating Expenses' ELSE 'Revenue - Ecommerce' END AS cash_flow_category,
       CAST(NULL AS VARCHAR) AS cash_flow_subcategory,
       CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,4)) AS amount,
       CAST(NULL AS VARCHAR) AS counterparty, 'Planned order ' || o_orderkey AS description,
       TRUE AS is_forecast,
       CASE o_orderkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'best' ELSE 'worst' END AS scenario_id,
       CAST(NULL AS VARCHAR) AS bank_account_id
FROM orders WHERE o_orderstatus = 'O'""",
    "planned_full": """
SELECT transaction_id, cash_date AS transaction_date, cash_date, CAST(NULL AS DATE) AS value_date, 'forecast' AS source_system,
       CAST(NULL AS VARCHAR) AS source_id, CAST(NULL AS VARCHAR) AS source_table, bank_account_id,
       CAST(NULL AS VARCHAR) AS bank_account_name, cash_flow_section, cash_flow_category, cash_flow_subcategory, amount,
       'USD' AS currency, counterparty, CAST(NULL AS VARCHAR) AS counterparty_type, description, CAST(NULL AS VARCHAR) AS notes,
       is_forecast, FALSE AS is_recurring, CAST(NULL AS VARCHAR) AS recurring_id, scenario_id, CAST(NULL AS VARCHAR[]) AS tags,
       'system' AS created_by FROM planned""",
    "ledger_full": """
SELECT * FROM deposit_rows UNION ALL BY NAME SELECT * FROM invoice_rows UNION ALL BY NAME SELECT * FROM planned_full""",
    "ledger": "SELECT * FROM actuals UNION ALL SELECT * FROM planned",
    "chosen_rows": """
SELECT * FROM ledger WHERE cash_date >= DATE '{AS_OF}' - 91 AND (NOT is_forecast OR scenario_id = 'base')""",
    "weeks_in_out": """
SELECT CAST(date_trunc('week', cash_date) AS DATE) AS week_start,
       CAST(date_trunc('week', cash_date) AS DATE) + 6 AS week_end, SUM(amount) AS net,
       SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS inflows,
       SUM(CASE WHEN amount < 0 THEN abs(amount) ELSE 0 END) AS outflows
FROM chosen_rows GROUP BY ALL""",
    "balances": """
SELECT *, (SELECT total_liquidity FROM position) + SUM(net) OVER (ORDER BY week_start) AS cash_balance,
       CAST(row_number() OVER (ORDER BY week_start) AS INTEGER) AS week_index FROM weeks_in_out""",
    "summary": """
SELECT MIN(CASE WHEN cash_balance < 0 THEN week_index END) AS runway_weeks, SUM(net) AS total_net,
       COUNT(*) AS weeks, max_by(cash_balance, week_start) AS last_balance,
       coalesce(bool_or(cash_balance < 0), FALSE) AS any_negative FROM balances""",
    "expenses": """
SELECT cash_flow_category, SUM(amount) AS whole, MIN(cash_date) AS first_day, MAX(cash_date) AS last_day
FROM actuals WHERE cash_date >= DATE '{AS_OF}' - 84 AND amount < 0 GROUP BY cash_flow_category""",
    "revenues": """
SELECT cash_flow_category, SUM(amount) AS whole, MIN(cash_date) AS first_day, MAX(cash_date) AS last_day
FROM actuals WHERE cash_date >= DATE '{AS_OF}' - 84 AND amount > 0 GROUP BY cash_flow_category""",
    "expense_row": """
SELECT total, weeks_in_range, total / weeks_in_range AS weekly_avg
FROM (SELECT CAST(abs(SUM(whole)) AS DOUBLE) AS total,
             greatest(CAST(MAX(last_day) - MIN(first_day) AS DOUBLE) / 7, 1.0) AS weeks_in_range FROM expenses)""",
    "factors": """
SELECT * FROM (VALUES ('base', 1.0::DOUBLE, 1.0::DOUBLE), ('best', 1.15, 0.90), ('worst', 0.85, 1.10))
       AS f(scenario, revenue_factor, expense_factor)""",
    "weeks": """
SELECT CAST(n AS INTEGER) AS week_number, DATE '{AS_OF}' + CAST(7 * (n - 1) AS INTEGER) AS week_start,
       DATE '{AS_OF}' + CAST(7 * (n - 1) + 6 AS INTEGER) AS week_end FROM range(1, 14) r(n)""",
    "opex_lines": """
SELECT week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
       'Operating Expenses' AS cash_flow_category, 'Week ' || week_number || ' - OpEx (forecast)' AS description,
       0.0 - weekly_avg * expense_factor AS amount, scenario
FROM expense_row, weeks, factors""",
    "recurring_lines": """
SELECT week_number, week_start, week_end, d AS transaction_date,
       CASE WHEN contains(cash_flow_category, 'Debt') OR contains(cash_flow_category, 'Loan')
            THEN 'Financing' ELSE 'Operating' END AS cash_flow_section,
       cash_flow_category, description || ' (recurring)' AS description, amount, scenario
FROM (SELECT *, week_start + CAST(n AS INTEGER) AS d FROM weeks, range(0, 7) r(n)) calendar
JOIN live_recurring ON day(d) = day_of_month, factors""",
    "debt_lines": """
SELECT week_number, week_start, week_end, payment_date AS transaction_date, 'Financing' AS cash_flow_section,
       'Debt Service' AS cash_flow_category, loan_name || ' - ' || lender AS description,
       0.0 - payment_amount AS amount, scenario
FROM due_debt JOIN weeks ON payment_date BETWEEN week_start AND week_end, factors""",
    "revenue_lines": """
SELECT week_number, week_start, week_end, week_end AS transaction_date, 'Operating' AS cash_flow_section,
       'Revenue - Ecommerce' AS cash_flow_category, 'Week ' || week_number || ' - Revenue (forecast)' AS description,
       CAST(75000.0 AS DOUBLE) * revenue_factor AS amount, scenario
FROM weeks, factors""",
    "lines": """
SELECT * FROM opex_lines UNION ALL SELECT * FROM recurring_lines UNION ALL SELECT * FROM debt_lines
UNION ALL SELECT * FROM revenue_lines""",
    "exact_lines": "SELECT *, CAST(amount AS DECIMAL(18,4)) AS exact FROM lines",
    "week_nets": """
SELECT scenario, week_number, week_start, week_end, SUM(exact) AS net FROM exact_lines GROUP BY ALL""",
    "week_balances": """
SELECT *, 250000 + SUM(net) OVER (PARTITION BY scenario ORDER BY week_number) AS balance FROM week_nets""",
}

PARAMETERS = {"{AS_OF}": "1998-07-01", "{START}": "1995-02-10", "{END}": "2001-05-20",
              "{FIRST_DAY}": "1990-01-01", "{LAST_DAY}": "2030-12-31"}


def _needed(sql: str, seen: list[str]) -> None:
    """Append the views that ``sql`` mentions, each after those it needs."""
    for word in dict.fromkeys(re.findall(r"(?:\bFROM|\bJOIN|,)\s*(\w+)", sql)):
        if word in VIEWS and word not in seen:
            _needed(VIEWS[word], seen)
            if word not in seen:
                seen.append(word)


def with_views(body: str) -> str:
    """``body`` below a WITH clause of the views it uses."""
    seen: list[str] = []
    _needed(body, seen)
    clause = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in seen)
    text = f"WITH {clause}\n{body}" if seen else body
    for mark, value in PARAMETERS.items():
        text = text.replace(mark, value)
    return text
