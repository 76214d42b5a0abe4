"""Reporting queries over the source tables.

All of them filter first, aggregate on the map side and shuffle only group
keys.  Dimension joins carry no broadcast hint: Catalyst broadcasts a vendor or
item table when its statistics allow, and otherwise runs a sort-merge join that
adaptive execution splits on skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.classify import channel_label
from tillflow.functions.dates import DateLike, day_between
from tillflow.functions.money import from_units, money_sum, negated_sum, units

# Days from sale to payout, from order to delivery, and the
# payment days of a vendor without terms.
PAYOUT_LAG_DAYS = 2
DELIVERY_DAYS = 30
DEFAULT_PAYMENT_DAYS = 30


def payout_date(event_time: str = "date_time") -> Column:
    return F.date_add(F.to_date(event_time), PAYOUT_LAG_DAYS)


def payment_terms_of(vendors: DataFrame) -> DataFrame:
    """Vendor name, terms and the day counts, under collision-free names."""
    return vendors.select(F.col("Name").alias("vendor_name"),
                          F.col("Terms").alias("payment_terms"),
                          F.col("`Actual Days`").alias("actual_days"),
                          F.col("`Request Days`").alias("request_days"))


def payment_days() -> Column:
    """Actual days, else requested days, else 30; an INT for date_add."""
    return F.coalesce("actual_days", "request_days", F.lit(DEFAULT_PAYMENT_DAYS)).cast("int")


def with_payment_terms(rows: DataFrame, vendors: DataFrame) -> DataFrame:
    terms = payment_terms_of(vendors)
    joined = rows.join(terms, rows["vendor"] == terms["vendor_name"], "left")
    return (joined.withColumn("payment_days", payment_days())
            .drop("vendor_name", "actual_days", "request_days"))


def revenue_by_channel(deposits: DataFrame, start: DateLike | None = None,
                       end: DateLike | None = None) -> DataFrame:
    """Deposits by payout date and platform with fee rate."""
    daily = (deposits
             .where(day_between(F.to_date("date_time"), start, end))
             .groupBy(payout_date().alias("cash_date"), "platform")
             .agg(money_sum("product_sales").alias("gross_product_sales"),
                  money_sum("shipping_credits").alias("gross_shipping"),
                  money_sum("gift_wrap_credits").alias("gross_gift_wrap"),
                  money_sum("promotional_rebates").alias("promotional_rebates"),
                  money_sum("selling_fees").alias("platform_fees"),
                  money_sum("fba_fees").alias("fulfillment_fees"),
                  money_sum("other_transaction_fees").alias("other_fees"),
                  money_sum("total").alias("cash_amount"),
                  F.countDistinct("order_id").alias("order_count"),
                  F.countDistinct("settlement_id").alias("settlement_count"),
                  F.sum("quantity").alias("units_sold")))
    all_fees = F.col("platform_fees") + F.col("fulfillment_fees") + F.col("other_fees")
    return daily.select(
        "cash_date", "platform",
        channel_label(F.col("platform"), "Operating Inflows - Revenue - ").alias("cash_flow_category"),
        F.lit("Ecommerce Revenue").alias("cash_flow_subcategory"),
        "gross_product_sales", "gross_shipping", "gross_gift_wrap", "promotional_rebates",
        "platform_fees", "fulfillment_fees", "other_fees", "cash_amount",
        "order_count", "settlement_count", "units_sold",
        (F.try_divide(all_fees, "gross_product_sales") * 100).alias("effective_fee_rate_pct"),
    ).orderBy(F.desc("cash_date"), "platform")


def refunds_by_platform(refunds: DataFrame, start: DateLike | None = None,
                        end: DateLike | None = None) -> DataFrame:
    """Refund magnitudes and their signed net by payout date and platform."""
    daily = (refunds
             .where(day_between(F.to_date("date_time"), start, end))
             .groupBy(payout_date().alias("cash_date"), "platform")
             .agg(money_sum(F.abs("product_sales")).alias("total_refund_amount"),
                  money_sum(F.abs("shipping_credits")).alias("shipping_refunds"),
                  money_sum(F.abs("selling_fees")).alias("fee_reversals"),
                  money_sum(F.abs("fba_fees")).alias("fba_fee_reversals"),
                  money_sum("total").alias("cash_amount"),
                  F.countDistinct("order_id").alias("refund_count"),
                  F.sum(F.abs("quantity")).alias("units_refunded")))
    return daily.select(
        "cash_date", "platform",
        channel_label(F.col("platform"), "Operating Inflows - Revenue - ").alias("cash_flow_category"),
        F.lit("Refunds (Contra-Revenue)").alias("cash_flow_subcategory"),
        "total_refund_amount", "shipping_refunds", "fee_reversals", "fba_fee_reversals",
        "cash_amount", "refund_count", "units_refunded",
        F.lit(None).cast("double").alias("refund_rate_pct"),
    ).orderBy(F.desc("cash_date"), "platform")


def cogs_and_fees(fees: DataFrame, start: DateLike | None = None,
                  end: DateLike | None = None) -> DataFrame:
    """Fee magnitudes by payout date and platform.

    The line total is NULL when one of its fees is NULL, while each fee's own
    sum skips NULLs; so ``total_fees`` can be less than the three sums.
    """
    selling, fba, other = (units(F.abs(c)) for c in
                           ("selling_fees", "fba_fees", "other_transaction_fees"))
    daily = (fees
             .where(day_between(F.to_date("date_time"), start, end))
             .groupBy(payout_date().alias("cash_date"), "platform")
             .agg(from_units(F.sum(selling)).alias("platform_selling_fees"),
                  from_units(F.sum(fba)).alias("fulfillment_fees"),
                  from_units(F.sum(other)).alias("other_fees"),
                  from_units(F.sum(selling + fba + other)).alias("total_fees"),
                  F.countDistinct("order_id").alias("order_count"),
                  F.countDistinct("settlement_id").alias("settlement_count")))
    return daily.select(
        "cash_date", "platform", "platform_selling_fees",
        F.lit("COGS - Platform Fees").alias("selling_fee_category"),
        "fulfillment_fees",
        F.lit("COGS - Fulfillment").alias("fulfillment_fee_category"),
        "other_fees",
        F.lit("COGS - Other Transaction Fees").alias("other_fee_category"),
        "total_fees", "order_count", "settlement_count",
        F.lit("DEDUCTED_FROM_DEPOSITS").alias("cash_treatment"),
    ).orderBy(F.desc("cash_date"), "platform")


def vendor_payments(invoices: DataFrame, vendors: DataFrame, start: DateLike | None = None,
                    end: DateLike | None = None) -> DataFrame:
    """Invoices by estimated payment date, vendor and terms; outflow is negative."""
    dated = with_payment_terms(
        invoices.where(day_between(F.col("invoice_date"), start, end)), vendors)
    daily = (dated
             .groupBy(F.date_add("invoice_date", F.col("payment_days")).alias("cash_date"),
                      "vendor", "payment_terms")
             .agg(money_sum("subtotal").alias("subtotal_amount"),
                  money_sum("sales_tax").alias("tax_amount"),
                  negated_sum("total").alias("cash_amount"),
                  F.countDistinct("invoice_id").alias("invoice_count"),
                  F.countDistinct("po_number").alias("po_count")))
    return daily.select(
        "cash_date", "vendor", "payment_terms",
        F.lit("COGS - Materials").alias("cash_flow_category"),
        F.lit("Vendor Payments").alias("cash_flow_subcategory"),
        "subtotal_amount", "tax_amount", "cash_amount", "invoice_count", "po_count",
        F.lit("ESTIMATED_BY_TERMS").alias("payment_date_source"),
    ).orderBy(F.desc("cash_date"), "vendor", "payment_terms")


def purchase_commitments(po_lines: DataFrame, items: DataFrame, vendors: DataFrame,
                         start: DateLike | None = None,
                         end: DateLike | None = None) -> DataFrame:
    """Open purchase-order lines as future outflows."""
    outstanding = F.col("qty_ordered") - F.coalesce("qty_received", F.lit(0))
    open_lines = (po_lines
                  .where((F.col("status") == "Open")
                         & day_between(F.col("order_date"), start, end)
                         & (outstanding > 0))
                  .select("po_no", "order_date", "vendor", "sku",
                          outstanding.alias("qty_outstanding")))
    prices = items.select(F.col("sku").alias("item_sku"),
                          F.coalesce("item_price", "build_cost", F.lit(0.0)).alias("unit_price"))
    priced = open_lines.join(prices, F.col("sku") == F.col("item_sku"), "left")
    delivery = F.date_add("order_date", DELIVERY_DAYS)
    # an SKU without an item row is worth nothing
    value = F.coalesce("unit_price", F.lit(0.0)) * F.col("qty_outstanding")
    # One row per vendor and day meets the vendors, however many lines a vendor has; its
    # distinct orders are counted before, spread over the order numbers.
    per_day = priced.groupBy("order_date", "vendor").agg(
        F.sum(units(value)).alias("whole"), F.sum("qty_outstanding").alias("units"),
        F.countDistinct("po_no").alias("po_count"), F.count(F.lit(1)).alias("line_count"))
    grouped = (with_payment_terms(per_day, vendors)
               .groupBy(delivery.alias("estimated_delivery_date"),
                        F.date_add(delivery, F.col("payment_days")).alias("cash_date"),
                        "vendor", "payment_terms")
               .agg(from_units(-F.sum("whole")).alias("cash_amount"),
                    F.sum("units").alias("units"), F.max("po_count").alias("po_count"),
                    F.sum("line_count").alias("line_count")))
    return grouped.select(
        "cash_date", "vendor", "payment_terms",
        F.lit("COGS - Materials").alias("cash_flow_category"),
        F.lit("Inventory Purchases (Committed)").alias("cash_flow_subcategory"),
        "cash_amount", "units", "po_count", "line_count", "estimated_delivery_date",
        F.lit("FORECAST_FROM_OPEN_PO").alias("source"),
    ).orderBy("cash_date", "vendor", "payment_terms", "estimated_delivery_date")


# ---- consolidated statement -------------------------------------------------

def operating_inflows(deposits: DataFrame, start: DateLike | None = None,
                      end: DateLike | None = None) -> DataFrame:
    return (deposits.where(day_between(F.to_date("date_time"), start, end))
            .groupBy(payout_date().alias("cash_date"), "platform")
            .agg(money_sum("total").alias("cash_amount"))
            .select("cash_date", "platform",
                    F.lit("Operating Inflows").alias("cash_flow_section"),
                    channel_label(F.col("platform"), "Revenue - ").alias("cash_flow_category"),
                    "cash_amount"))


def refund_flows(refunds: DataFrame, start: DateLike | None = None,
                 end: DateLike | None = None) -> DataFrame:
    return (refunds.where(day_between(F.to_date("date_time"), start, end))
            .groupBy(payout_date().alias("cash_date"), "platform")
            .agg(money_sum("total").alias("cash_amount"))
            .select("cash_date", "platform",
                    F.lit("Operating Inflows").alias("cash_flow_section"),
                    F.lit("Refunds").alias("cash_flow_category"), "cash_amount"))


def vendor_outflows(invoices: DataFrame, vendors: DataFrame, start: DateLike | None = None,
                    end: DateLike | None = None) -> DataFrame:
    """Vendor payments by date.

    Invoices are summed per day and vendor before the vendor join, so a vendor
    with a large share of the rows reaches the join as one row per day.
    """
    per_day = (invoices.where(day_between(F.col("invoice_date"), start, end))
               .groupBy("invoice_date", "vendor").agg(F.sum(units("total")).alias("whole")))
    return (with_payment_terms(per_day, vendors)
            .groupBy(F.date_add("invoice_date", F.col("payment_days")).alias("cash_date"), "vendor")
            .agg(from_units(-F.sum("whole")).alias("cash_amount"))
            .select("cash_date", F.col("vendor").alias("platform"),
                    F.lit("Operating Outflows").alias("cash_flow_section"),
                    F.lit("Vendor Payments").alias("cash_flow_category"), "cash_amount"))


def daily_rollup(flows: DataFrame) -> DataFrame:
    return (flows.groupBy("cash_date", "cash_flow_section", "cash_flow_category")
            .agg(money_sum("cash_amount").alias("cash_amount")))


def running_balance(daily: DataFrame, starting_balance: float = 0.0) -> DataFrame:
    """Ending and beginning balance per row in (date, section, category) order.

    The window has one partition, so its input must be the daily rollup: at
    most days x categories rows whatever the size of the fact tables.
    """
    order = Window.orderBy("cash_date", "cash_flow_section", "cash_flow_category")
    so_far = F.sum(units("cash_amount")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ending = from_units(units(F.lit(float(starting_balance))) + so_far)
    return (daily.withColumn("ending_cash_balance", ending)
            .withColumn("beginning_cash_balance",
                        F.lag("ending_cash_balance", 1, float(starting_balance)).over(order)))


def consolidated_cash_flow(deposits: DataFrame, refunds: DataFrame, invoices: DataFrame,
                           vendors: DataFrame, start: DateLike | None = None,
                           end: DateLike | None = None,
                           starting_balance: float = 0.0) -> DataFrame:
    """Daily cash-flow statement with running balance.

    Each branch aggregates before the union, so the union carries group rows.
    """
    flows = (operating_inflows(deposits, start, end)
             .unionByName(refund_flows(refunds, start, end))
             .unionByName(vendor_outflows(invoices, vendors, start, end)))
    return (running_balance(daily_rollup(flows), starting_balance)
            .orderBy(F.desc("cash_date"), "cash_flow_section", "cash_flow_category"))


# ---- small source reports ---------------------------------------------------

def platform_daily_summary(deposits: DataFrame, start: DateLike | None = None,
                           end: DateLike | None = None) -> DataFrame:
    return (deposits.where(day_between(F.to_date("date_time"), start, end))
            .groupBy("platform", F.to_date("date_time").alias("date"))
            .agg(F.countDistinct("order_id").alias("order_count"),
                 money_sum("product_sales").alias("gross_sales"),
                 money_sum("selling_fees").alias("platform_fees"),
                 money_sum("fba_fees").alias("fulfillment_fees"),
                 money_sum("total").alias("net_proceeds"))
            .orderBy(F.desc("date"), "platform"))


def vendor_terms(vendors: DataFrame) -> DataFrame:
    return vendors.select("Name", "Terms", "`Actual Days`").na.drop(subset=["Terms"])


def open_po_by_vendor(po_lines: DataFrame) -> DataFrame:
    """Open lines per vendor: lines with a number, units ordered and received."""
    return (po_lines.where(F.col("status") == "Open")
            .groupBy(F.col("vendor").alias("Vendor"))
            .agg(F.count("po_no").alias("PO Lines"),
                 F.coalesce(F.sum("qty_ordered"), F.lit(0)).alias("Qty Ordered"),
                 F.coalesce(F.sum("qty_received"), F.lit(0)).alias("Qty Received")))
