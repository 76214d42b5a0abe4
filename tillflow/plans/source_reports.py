"""Readers, reporting queries and loads over the source tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from tillflow.operators import etl, reports
from tillflow.plans.registry import END, FIRST_DAY, LAST_DAY, START, register
from tillflow.sources import files
from tillflow.sources.adapters import TestTables
from tillflow.sources.warehouse import Warehouse

SQL_FOLDER = Path(__file__).parent / "sql"
RANGE = "BETWEEN DATE '{START}' AND DATE '{END}'"
ALL_DAYS = "BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
CHANNEL = "CASE WHEN platform IN ('Amazon', 'Shopify', 'TikTok') THEN '{p}' || platform ELSE '{p}Other' END"
LEDGER_OUT = """* EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount"""


def warehouse(t: TestTables) -> Warehouse:
    return Warehouse(t.spark, tables={
        "deposits": t.deposits, "orders": t.sales_orders, "fees": t.fees, "refunds": t.refunds,
        "forecast": t.sku_forecast, "vendors": t.vendors, "po_line_item": t.po_line_item,
        "invoices": t.invoices, "item": t.item})


# Whole rows of the sales tables; the source's constant columns as the test data has them.
IN_RANGE = f"WHERE CAST(date_time AS DATE) {RANGE}"
ON_ANY_DAY = f"WHERE CAST(date_time AS DATE) {ALL_DAYS}"
SALES_MONEY = ["product_sales", "shipping_credits", "gift_wrap_credits", "promotional_rebates", "selling_fees",
               "fba_fees", "other_transaction_fees", "total"]
SALES_TAXES = ["product_sales_tax", "shipping_credits_tax", "gift_wrap_credits_tax", "promotional_rebate_tax",
               "marketplace_tax"]
SALES_OUT = ("SELECT platform, date_time, settlement_id, 'Order' AS type, order_id, sku, 'Sale' AS description, quantity, "
             "'web' AS marketplace, 'Merchant' AS fulfillment, "
             + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SALES_MONEY) + ", "
             + ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in SALES_TAXES)
             + ", customer_id, order_line_id, return_flag FROM {table} " + IN_RANGE)
ORDERS_OUT = ("SELECT platform, date_time, settlement_id, order_id, sku, quantity, 'Merchant' AS fulfillment, "
              + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SALES_MONEY if c != "gift_wrap_credits")
              + ", customer_id, order_line_id FROM sales_lines " + IN_RANGE)


# ---- readers ----------------------------------------------------------------

register("table_scan",
         lambda t: warehouse(t).table_scan(
             "deposits", columns=["platform", "date_time", "order_id", "sku", "total"],
             where="platform = 'Amazon' AND total > 0",
             order_by=["date_time", "order_id", "sku", "total"], limit=1000),
         """SELECT platform, date_time, order_id, sku, CAST(total AS DOUBLE) AS total
            FROM deposits WHERE platform = 'Amazon' AND total > 0
            ORDER BY date_time, order_id, sku, total LIMIT 1000""")

register("sql_query",
         lambda t: warehouse(t).sql(
             "SELECT settlement_id, count(*) AS line_count, sum(quantity) AS units FROM {deposits} "
             "WHERE platform = :platform GROUP BY settlement_id",
             {"platform": "Amazon"}, deposits=t.deposits),
         """SELECT settlement_id, COUNT(*) AS line_count, CAST(SUM(quantity) AS BIGINT) AS units
            FROM deposits WHERE platform = 'Amazon' GROUP BY settlement_id""")

register("sql_template",
         lambda t: warehouse(t).sql_file(SQL_FOLDER / "platform_daily.sql",
                                         {"start_date": FIRST_DAY, "end_date": LAST_DAY},
                                         deposits=t.deposits),
         """SELECT platform, CAST(date_time AS DATE) AS date, COUNT(*) AS line_count,
                   CAST(SUM(quantity) AS BIGINT) AS units
            FROM deposits """ + ON_ANY_DAY + " GROUP BY ALL")

register("read_deposits", lambda t: warehouse(t).deposits(START, END), SALES_OUT.replace("{table}", "deposits"))
register("read_orders", lambda t: warehouse(t).orders(START, END), ORDERS_OUT)
register("read_fees", lambda t: warehouse(t).fees(START, END), SALES_OUT.replace("{table}", "fees"))
register("read_refunds", lambda t: warehouse(t).refunds(START, END, "TikTok"),
         SALES_OUT.replace("{table}", "refunds") + " AND platform = 'TikTok'")
register("read_sku_forecast", lambda t: warehouse(t).sku_forecast(FIRST_DAY, LAST_DAY),
         f"""SELECT month, sku, platform, forecast_units,
                   CAST(forecast_revenue AS DOUBLE) AS forecast_revenue FROM sku_forecast WHERE month {ALL_DAYS}""")
register("read_vendors", lambda t: warehouse(t).vendors(), "SELECT * FROM vendors")
register("read_purchase_orders", lambda t: warehouse(t).purchase_orders("Open", FIRST_DAY, LAST_DAY),
         f"SELECT * FROM po_line_item WHERE status = 'Open' AND order_date {ALL_DAYS}")
register("read_invoices", lambda t: warehouse(t).invoices(FIRST_DAY, LAST_DAY),
         f"""SELECT * EXCLUDE (subtotal, sales_tax, total), CAST(subtotal AS DOUBLE) AS subtotal,
                   CAST(sales_tax AS DOUBLE) AS sales_tax, CAST(total AS DOUBLE) AS total
            FROM invoices WHERE invoice_date {ALL_DAYS}""")
register("read_items", lambda t: warehouse(t).items(),
         """SELECT sku, product, CAST(item_price AS DOUBLE) AS item_price,
                   CAST(build_cost AS DOUBLE) AS build_cost FROM item""")

register("coa_csv_scan", lambda t: files.parse_account_list(t.coa_lines()),
         "SELECT * EXCLUDE (leaf, parent_name) FROM chart")
register("payout_csv_scan",
         lambda t: files.parse_payout_report(t.payout_csv_lines()).select(
             F.to_utc_timestamp("transaction_time", F.current_timezone())
              .cast("timestamp_ntz").alias("transaction_time"),
             "type", "order", "card_brand", "card_source", "payout_status", "payout_date", "payout_id", "available_on",
             "amount", "fee", "net", "checkout", "payment_method_name", "presentment_amount",
             "presentment_currency", "currency"),
         """SELECT date_trunc('second', transaction_time) + INTERVAL 6 HOUR AS transaction_time,
                   'charge' AS type, '#' || event_id AS "order", 'visa' AS card_brand, 'online' AS card_source,
                   'paid' AS payout_status, payout_id, payout_date, payout_date AS available_on, '#1' AS checkout,
                   'card' AS payment_method_name, value AS presentment_amount, 'USD' AS presentment_currency,
                   CAST(value_amount AS DOUBLE) AS amount, CAST(fee_amount AS DOUBLE) AS fee,
                   CAST(net_amount AS DOUBLE) AS net, 'USD' AS currency FROM payouts""")
register("loan_table", lambda t: files.parse_loan_configs(t.loan_config_lines()),
         """SELECT loan_id, loan_name, lender, 'Term Loan' AS loan_type, original_amount,
                   current_balance, annual_rate, payment_day, start_date, maturity_date,
                   structure_choice, io_months, amort_months, fixed_payment, balloon_amount
            FROM loans""")


# ---- reporting queries ------------------------------------------------------

register("revenue_by_channel", lambda t: reports.revenue_by_channel(t.deposits, FIRST_DAY, LAST_DAY), f"""
SELECT cash_date, platform, {CHANNEL.format(p='Operating Inflows - Revenue - ')} AS cash_flow_category,
       'Ecommerce Revenue' AS cash_flow_subcategory, gross_product_sales, gross_shipping, gross_gift_wrap,
       promotional_rebates, platform_fees, fulfillment_fees, other_fees, cash_amount,
       order_count, settlement_count, units_sold,
       CASE WHEN gross_product_sales <> 0
            THEN (platform_fees + fulfillment_fees + other_fees) / gross_product_sales * 100 END
         AS effective_fee_rate_pct
FROM (SELECT CAST(date_time AS DATE) + 2 AS cash_date, platform,
             CAST(SUM(product_sales) AS DOUBLE) AS gross_product_sales,
             CAST(SUM(shipping_credits) AS DOUBLE) AS gross_shipping,
             CAST(SUM(gift_wrap_credits) AS DOUBLE) AS gross_gift_wrap,
             CAST(SUM(promotional_rebates) AS DOUBLE) AS promotional_rebates,
             CAST(SUM(selling_fees) AS DOUBLE) AS platform_fees,
             CAST(SUM(fba_fees) AS DOUBLE) AS fulfillment_fees,
             CAST(SUM(other_transaction_fees) AS DOUBLE) AS other_fees,
             CAST(SUM(total) AS DOUBLE) AS cash_amount,
             COUNT(DISTINCT order_id) AS order_count,
             COUNT(DISTINCT settlement_id) AS settlement_count,
             CAST(SUM(quantity) AS BIGINT) AS units_sold
      FROM deposits {ON_ANY_DAY} GROUP BY ALL)
ORDER BY cash_date DESC, platform""")

register("refunds_by_platform", lambda t: reports.refunds_by_platform(t.refunds, FIRST_DAY, LAST_DAY), f"""
SELECT CAST(date_time AS DATE) + 2 AS cash_date, platform,
       {CHANNEL.format(p='Operating Inflows - Revenue - ')} AS cash_flow_category,
       'Refunds (Contra-Revenue)' AS cash_flow_subcategory,
       CAST(SUM(abs(product_sales)) AS DOUBLE) AS total_refund_amount,
       CAST(SUM(abs(shipping_credits)) AS DOUBLE) AS shipping_refunds,
       CAST(SUM(abs(selling_fees)) AS DOUBLE) AS fee_reversals,
       CAST(SUM(abs(fba_fees)) AS DOUBLE) AS fba_fee_reversals,
       CAST(SUM(total) AS DOUBLE) AS cash_amount, COUNT(DISTINCT order_id) AS refund_count,
       CAST(SUM(abs(quantity)) AS BIGINT) AS units_refunded, CAST(NULL AS DOUBLE) AS refund_rate_pct
FROM refunds {ON_ANY_DAY}
GROUP BY 1, 2 ORDER BY cash_date DESC, platform""")

register("cogs_and_fees", lambda t: reports.cogs_and_fees(t.fees, FIRST_DAY, LAST_DAY), f"""
SELECT CAST(date_time AS DATE) + 2 AS cash_date, platform,
       CAST(SUM(abs(selling_fees)) AS DOUBLE) AS platform_selling_fees,
       'COGS - Platform Fees' AS selling_fee_category,
       CAST(SUM(abs(fba_fees)) AS DOUBLE) AS fulfillment_fees,
       'COGS - Fulfillment' AS fulfillment_fee_category,
       CAST(SUM(abs(other_transaction_fees)) AS DOUBLE) AS other_fees,
       'COGS - Other Transaction Fees' AS other_fee_category,
       CAST(SUM(abs(selling_fees) + abs(fba_fees) + abs(other_transaction_fees)) AS DOUBLE) AS total_fees,
       COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT settlement_id) AS settlement_count,
       'DEDUCTED_FROM_DEPOSITS' AS cash_treatment
FROM fees {ON_ANY_DAY}
GROUP BY 1, 2 ORDER BY cash_date DESC, platform""")

register("vendor_payments", lambda t: reports.vendor_payments(t.invoices, t.vendors, FIRST_DAY, LAST_DAY), f"""
SELECT cash_date, vendor, payment_terms, 'COGS - Materials' AS cash_flow_category,
       'Vendor Payments' AS cash_flow_subcategory, CAST(SUM(subtotal) AS DOUBLE) AS subtotal_amount,
       CAST(SUM(sales_tax) AS DOUBLE) AS tax_amount, CAST(-SUM(total) AS DOUBLE) AS cash_amount,
       COUNT(DISTINCT invoice_id) AS invoice_count, COUNT(DISTINCT po_number) AS po_count,
       'ESTIMATED_BY_TERMS' AS payment_date_source
FROM dated_invoices WHERE invoice_date {ALL_DAYS}
GROUP BY cash_date, vendor, payment_terms ORDER BY cash_date DESC, vendor""")

register("purchase_commitments",
         lambda t: reports.purchase_commitments(t.po_line_item, t.item, t.vendors, FIRST_DAY, LAST_DAY), f"""
SELECT order_date + 30 + payment_days AS cash_date, vendor, payment_terms,
       'COGS - Materials' AS cash_flow_category,
       'Inventory Purchases (Committed)' AS cash_flow_subcategory,
       CAST(-SUM(outstanding * price) AS DOUBLE) AS cash_amount,
       CAST(SUM(outstanding) AS BIGINT) AS units, COUNT(DISTINCT po_no) AS po_count,
       COUNT(*) AS line_count, order_date + 30 AS estimated_delivery_date,
       'FORECAST_FROM_OPEN_PO' AS source
FROM (SELECT p.*, d.payment_terms, coalesce(d.known_days, 30) AS payment_days,
             qty_ordered - coalesce(qty_received, 0) AS outstanding,
             coalesce(item_price, build_cost, 0) AS price
      FROM po_line_item p LEFT JOIN item i ON p.sku = i.sku
      LEFT JOIN vendor_days d ON p.vendor = d.vendor_name
      WHERE p.status = 'Open' AND order_date {ALL_DAYS})
WHERE outstanding > 0
GROUP BY order_date, payment_days, vendor, payment_terms ORDER BY cash_date, vendor""")

INFLOWS = f"""
SELECT CAST(date_time AS DATE) + 2 AS cash_date, platform, 'Operating Inflows' AS cash_flow_section,
       {CHANNEL.format(p='Revenue - ')} AS cash_flow_category, SUM(total) AS cash_amount
FROM deposits {ON_ANY_DAY} GROUP BY 1, 2"""
REFUND_FLOWS = f"""
SELECT CAST(date_time AS DATE) + 2 AS cash_date, platform, 'Operating Inflows' AS cash_flow_section,
       'Refunds' AS cash_flow_category, SUM(total) AS cash_amount
FROM refunds {ON_ANY_DAY} GROUP BY 1, 2"""
OUTFLOWS = f"""
SELECT cash_date, vendor AS platform, 'Operating Outflows' AS cash_flow_section,
       'Vendor Payments' AS cash_flow_category, -SUM(total) AS cash_amount
FROM dated_invoices WHERE invoice_date {ALL_DAYS} GROUP BY cash_date, vendor"""
DAILY = f"""
SELECT cash_date, cash_flow_section, cash_flow_category, SUM(cash_amount) AS cash_amount
FROM ({INFLOWS} UNION ALL {REFUND_FLOWS} UNION ALL {OUTFLOWS}) GROUP BY ALL"""
AS_DOUBLE = "SELECT * REPLACE (CAST(cash_amount AS DOUBLE) AS cash_amount) FROM ({})"

register("operating_inflows", lambda t: reports.operating_inflows(t.deposits, FIRST_DAY, LAST_DAY),
         AS_DOUBLE.format(INFLOWS))
register("refund_flows", lambda t: reports.refund_flows(t.refunds, FIRST_DAY, LAST_DAY),
         AS_DOUBLE.format(REFUND_FLOWS))
register("vendor_outflows", lambda t: reports.vendor_outflows(t.invoices, t.vendors, FIRST_DAY, LAST_DAY),
         AS_DOUBLE.format(OUTFLOWS))
register("consolidated_cash_flow",
         lambda t: reports.consolidated_cash_flow(t.deposits, t.refunds, t.invoices, t.vendors,
                                                  FIRST_DAY, LAST_DAY, 250000.0), f"""
SELECT cash_date, cash_flow_section, cash_flow_category, CAST(cash_amount AS DOUBLE) AS cash_amount,
       CAST(ending AS DOUBLE) AS ending_cash_balance,
       CAST(lag(ending, 1, 250000) OVER (ORDER BY cash_date, cash_flow_section, cash_flow_category)
            AS DOUBLE) AS beginning_cash_balance
FROM (SELECT *, 250000 + SUM(cash_amount) OVER (
                  ORDER BY cash_date, cash_flow_section, cash_flow_category
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ending
      FROM ({DAILY}))""")

register("platform_daily_summary", lambda t: reports.platform_daily_summary(t.deposits, START, END), f"""
SELECT platform, CAST(date_time AS DATE) AS date, COUNT(DISTINCT order_id) AS order_count,
       CAST(SUM(product_sales) AS DOUBLE) AS gross_sales,
       CAST(SUM(selling_fees) AS DOUBLE) AS platform_fees,
       CAST(SUM(fba_fees) AS DOUBLE) AS fulfillment_fees, CAST(SUM(total) AS DOUBLE) AS net_proceeds
FROM deposits WHERE CAST(date_time AS DATE) {RANGE} GROUP BY 1, 2""")
register("vendor_terms", lambda t: reports.vendor_terms(t.vendors),
         'SELECT "Name", "Terms", "Actual Days" FROM vendors WHERE "Terms" IS NOT NULL')
register("open_po_by_vendor", lambda t: reports.open_po_by_vendor(t.po_line_item), """
SELECT vendor AS "Vendor", COUNT(po_no) AS "PO Lines", CAST(SUM(qty_ordered) AS BIGINT) AS "Qty Ordered",
       CAST(coalesce(SUM(qty_received), 0) AS BIGINT) AS "Qty Received"
FROM po_line_item WHERE status = 'Open' GROUP BY vendor""")


# ---- loads ------------------------------------------------------------------

def _settled_out(columns: str) -> str:
    names = ["gross_product_sales", "gross_shipping", "gross_gift_wrap", "promotional_rebates",
             "platform_fees", "fulfillment_fees", "other_fees", "net_cash_received"]
    casts = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
    return (f"SELECT platform, settlement_id, settlement_start, settlement_end, {casts}, "
            f"CAST(0.0 AS DOUBLE) AS taxes_collected, order_count, "
            f"CAST(units_sold AS BIGINT) AS units_sold, cash_date FROM {columns}")


COMPARED = ["created_at", "updated_at"]

register("settle_deposits", lambda t: etl.settle_deposits(t.deposits, FIRST_DAY, LAST_DAY),
         _settled_out("settled_on_any_day"))
register("deposits_to_ledger",
         lambda t: etl.deposits_to_ledger(etl.settle_deposits(t.deposits), ids="hash").drop(*COMPARED),
         f"SELECT {LEDGER_OUT} FROM deposit_rows")
register("refunds_to_ledger",
         lambda t: etl.refunds_to_ledger(etl.settle_deposits(t.refunds), ids="hash").drop(*COMPARED),
         f"SELECT {LEDGER_OUT} FROM refund_rows")
register("invoices_to_ledger",
         lambda t: etl.invoices_to_ledger(t.invoices, t.vendors, ids="hash").drop(*COMPARED),
         f"SELECT {LEDGER_OUT} FROM invoice_rows")
register("deposits_preview",
         lambda t: etl.deposits_preview(t.deposits, START, END, ids="hash").drop(*COMPARED),
         f"SELECT {LEDGER_OUT} FROM deposit_rows_in_range")
register("deposits_preview_summary",
         lambda t: etl.preview_by_counterparty(etl.deposits_preview(t.deposits)),
         """SELECT counterparty, COUNT(amount) AS transaction_count,
                   CAST(SUM(amount) AS DOUBLE) AS total_amount FROM deposit_rows GROUP BY counterparty""")
register("deposits_preview_total",
         lambda t: etl.preview_total(etl.deposits_preview(t.deposits)),
         """SELECT COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
            FROM deposit_rows""")
register("invoices_preview", lambda t: etl.invoices_preview(t.invoices, t.vendors, FIRST_DAY, LAST_DAY), f"""
SELECT invoice_date AS transaction_date, cash_date, vendor AS counterparty, payment_terms, payment_days,
       CAST(-total AS DOUBLE) AS amount, COUNT(*) OVER () AS total_count,
       CAST(SUM(total) OVER () AS DOUBLE) AS total_amount
FROM dated_invoices WHERE total > 0 AND invoice_date {ALL_DAYS}""")
register("invoices_preview_summary",
         lambda t: etl.invoices_preview_summary(etl.invoices_preview(t.invoices, t.vendors)),
         """SELECT vendor AS counterparty, COUNT(*) AS transaction_count,
                   CAST(-SUM(total) AS DOUBLE) AS total_amount
            FROM dated_invoices WHERE total > 0 AND invoice_date IS NOT NULL
            GROUP BY vendor ORDER BY total_amount, counterparty LIMIT 10""")
