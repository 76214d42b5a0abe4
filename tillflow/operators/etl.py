"""Source rows to ledger rows, and the previews of those loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.classify import CHANNELS, revenue_category
from tillflow.functions.dates import DateLike, all_of, day_between
from tillflow.functions.money import from_units, money_sum, money_text, units
from tillflow.operators.reports import PAYOUT_LAG_DAYS, with_payment_terms
from tillflow.schemas import LEDGER, fill_missing

# The account that receives deposits and pays vendors, unless the caller names one.
DEFAULT_ACCOUNT = ("operating_checking", "Operating Checking")


def as_ledger(rows: DataFrame) -> DataFrame:
    """Project to the 26 ledger columns, filling the declared defaults."""
    return fill_missing(rows, LEDGER)


def row_id(ids: str, *parts: Column) -> Column:
    """``uuid``: a fresh id per load, as a plain append needs.
    ``hash``: the same source row always gets the same id, so a re-run can be
    anti-joined away; exact copies of a row then share one id.
    """
    if ids == "uuid":
        return F.uuid()
    if ids == "hash":
        return F.sha2(F.concat_ws("|", *parts), 256)
    raise ValueError(f"ids must be 'uuid' or 'hash', not {ids!r}")


def _source_filter(start: DateLike | None, end: DateLike | None, platform: str | None) -> Column:
    conditions = [day_between(F.to_date("date_time"), start, end)]
    if platform is not None:
        conditions.append(F.col("platform") == platform)
    return all_of(conditions)


def settle_deposits(deposits: DataFrame, start: DateLike | None = None,
                    end: DateLike | None = None, platform: str | None = None) -> DataFrame:
    """One row per (platform, settlement) with a non-zero net.

    The named channels pay out two days after the last day of the settlement,
    other platforms on that day.  Works for refunds as well.
    """
    last_day = F.max(F.to_date("date_time"))
    settled = (deposits.where(_source_filter(start, end, platform))
               .groupBy("platform", "settlement_id")
               .agg(F.min(F.to_date("date_time")).alias("settlement_start"),
                    last_day.alias("settlement_end"),
                    money_sum("product_sales").alias("gross_product_sales"),
                    money_sum("shipping_credits").alias("gross_shipping"),
                    money_sum("gift_wrap_credits").alias("gross_gift_wrap"),
                    money_sum("promotional_rebates").alias("promotional_rebates"),
                    money_sum("marketplace_tax").alias("taxes_collected"),
                    money_sum("selling_fees").alias("platform_fees"),
                    money_sum("fba_fees").alias("fulfillment_fees"),
                    money_sum("other_transaction_fees").alias("other_fees"),
                    money_sum("total").alias("net_cash_received"),
                    F.countDistinct("order_id").alias("order_count"),
                    F.sum("quantity").alias("units_sold")))
    end_day = F.col("settlement_end")
    cash_date = F.when(F.col("platform").isin(CHANNELS), F.date_add(end_day, PAYOUT_LAG_DAYS)) \
                 .otherwise(end_day)
    return settled.where(F.col("net_cash_received") != 0).withColumn("cash_date", cash_date)


def _settlement_rows(settled: DataFrame, source: str, category: Column, subcategory: str,
                     noun: str, tags: list[str], ids: str, account: tuple[str, str]) -> DataFrame:
    text = lambda name: F.col(name).cast("string")
    fees = from_units(units("platform_fees") + units("fulfillment_fees") + units("other_fees"))
    return as_ledger(settled.select(
        row_id(ids, F.lit(source), F.col("platform"), text("settlement_id")).alias("transaction_id"),
        F.col("settlement_end").alias("transaction_date"),
        "cash_date",
        F.col("cash_date").alias("value_date"),
        F.lit(source).alias("source_system"),
        text("settlement_id").alias("source_id"),
        F.lit(source).alias("source_table"),
        F.lit(account[0]).alias("bank_account_id"),
        F.lit(account[1]).alias("bank_account_name"),
        F.lit("Operating").alias("cash_flow_section"),
        category.alias("cash_flow_category"),
        F.lit(subcategory).alias("cash_flow_subcategory"),
        F.col("net_cash_received").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("platform").alias("counterparty"),
        F.lit("Platform").alias("counterparty_type"),
        F.concat(F.col("platform"), F.lit(f" {noun} "), text("settlement_id"), F.lit(" ("),
                 text("order_count"), F.lit(" orders, "), text("units_sold"),
                 F.lit(" units)")).alias("description"),
        F.concat(F.lit("Gross: $"), money_text(F.col("gross_product_sales")),
                 F.lit(", Fees: $"), money_text(F.abs(fees)),
                 F.lit(", Net: $"), money_text(F.col("net_cash_received"))).alias("notes"),
        F.array(F.col("platform"), *[F.lit(t) for t in tags]).alias("tags"),
        F.lit(f"etl_{source}").alias("created_by")))


def deposits_to_ledger(settled: DataFrame, ids: str = "uuid",
                       account: tuple[str, str] = DEFAULT_ACCOUNT) -> DataFrame:
    """Settlements as ledger inflows."""
    return _settlement_rows(settled, "deposits", revenue_category(F.col("platform")),
                            "Ecommerce Revenue", "Settlement", ["ecommerce", "revenue"],
                            ids, account)


def refunds_to_ledger(settled: DataFrame, ids: str = "uuid",
                      account: tuple[str, str] = DEFAULT_ACCOUNT) -> DataFrame:
    """Refund settlements as contra-revenue, with the timing of deposits."""
    return _settlement_rows(settled, "refunds", F.lit("Revenue - Refunds"), "Contra-Revenue",
                            "Refunds", ["ecommerce", "refund"], ids, account)


def deposits_preview(deposits: DataFrame, start: DateLike | None = None,
                     end: DateLike | None = None, platform: str | None = None,
                     ids: str = "uuid") -> DataFrame:
    """The rows a load would append, newest first."""
    rows = deposits_to_ledger(settle_deposits(deposits, start, end, platform), ids)
    return rows.orderBy(F.desc("cash_date"), "counterparty", "source_id")


def preview_by_counterparty(preview: DataFrame) -> DataFrame:
    return (preview.groupBy("counterparty")
            .agg(F.count("amount").alias("transaction_count"),
                 money_sum("amount").alias("total_amount")))


def preview_total(preview: DataFrame) -> DataFrame:
    return preview.agg(F.count(F.lit(1)).alias("transaction_count"),
                       F.coalesce(money_sum("amount"), F.lit(0.0)).alias("total_amount"))


def _payable(invoices: DataFrame, start: DateLike | None, end: DateLike | None) -> DataFrame:
    return invoices.where((F.col("total") > 0) & F.col("invoice_date").isNotNull()
                          & day_between(F.col("invoice_date"), start, end))


def _with_cash_date(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    return with_payment_terms(invoices, vendors).withColumn(
        "cash_date", F.date_add("invoice_date", F.col("payment_days")))


def invoices_to_ledger(invoices: DataFrame, vendors: DataFrame, start: DateLike | None = None,
                       end: DateLike | None = None, ids: str = "uuid",
                       account: tuple[str, str] = DEFAULT_ACCOUNT) -> DataFrame:
    """Positive, dated and identified invoices as ledger outflows."""
    payable = _payable(invoices, start, end).where(F.col("invoice_id").isNotNull())
    rows = _with_cash_date(payable, vendors)
    po_part = F.when(F.col("po_number").isNotNull(),
                     F.concat(F.lit(" (PO: "), F.col("po_number"), F.lit(")"))).otherwise("")
    identity = [F.lit("invoices"), F.col("invoice_id"), F.col("vendor"),
                F.col("invoice_date").cast("string"), units("total").cast("string")]
    return as_ledger(rows.select(
        row_id(ids, *identity).alias("transaction_id"),
        F.col("invoice_date").alias("transaction_date"),
        "cash_date",
        F.col("cash_date").alias("value_date"),
        F.lit("invoices").alias("source_system"),
        F.col("invoice_id").alias("source_id"),
        F.lit("invoices").alias("source_table"),
        F.lit(account[0]).alias("bank_account_id"),
        F.lit(account[1]).alias("bank_account_name"),
        F.lit("Operating").alias("cash_flow_section"),
        F.lit("COGS - Materials").alias("cash_flow_category"),
        F.lit("Vendor Payments").alias("cash_flow_subcategory"),
        (0.0 - F.col("total")).alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("vendor").alias("counterparty"),
        F.lit("Vendor").alias("counterparty_type"),
        F.concat(F.lit("Invoice "), F.col("invoice_number"), po_part).alias("description"),
        F.concat(F.lit("Payment terms: "), F.coalesce("payment_terms", F.lit("Net 30")),
                 F.lit(", Due: "), F.col("cash_date").cast("string"),
                 F.lit(", Subtotal: $"), money_text(F.col("subtotal")),
                 F.lit(", Tax: $"), money_text(F.col("sales_tax"))).alias("notes"),
        F.array(F.lit("vendor"), F.lit("expense"), F.lit("cogs")).alias("tags"),
        F.lit("etl_invoices").alias("created_by")))


def invoices_preview(invoices: DataFrame, vendors: DataFrame, start: DateLike | None = None,
                     end: DateLike | None = None) -> DataFrame:
    """Payable invoices with the grand count and total on every row.

    Invoices without an id are shown although a load skips them.  The grand
    totals come from a scalar subquery: a window over everything would move
    all rows into one task.
    """
    payable = _payable(invoices, start, end)
    rows = _with_cash_date(payable, vendors)
    # A vendor listed twice shows its invoices twice: the totals weigh each vendor's
    # sums by its rows, without joining the invoices a second time.
    listed = vendors.groupBy(F.col("Name").alias("_vendor")).agg(F.count(F.lit(1)).alias("times"))
    sums = payable.groupBy("vendor").agg(F.count(F.lit(1)).alias("n"), F.sum(units("total")).alias("whole"))
    weighed = sums.join(listed, F.col("vendor") == F.col("_vendor"), "left")
    times = F.coalesce("times", F.lit(1))
    totals = weighed.agg(F.struct(F.coalesce(F.sum(F.col("n") * times), F.lit(0)).alias("n"),
                                  from_units(F.sum(F.col("whole") * times)).alias("amount")).alias("t")).scalar()
    return (rows.select(F.col("invoice_date").alias("transaction_date"), "cash_date",
                        F.col("vendor").alias("counterparty"), "payment_terms", "payment_days",
                        (0.0 - F.col("total")).alias("amount"),
                        totals.alias("totals"))
            .select("*", F.col("totals.n").alias("total_count"),
                    F.col("totals.amount").alias("total_amount"))
            .drop("totals")
            .orderBy(F.desc("cash_date"), "counterparty", "transaction_date", "amount"))


def invoices_preview_summary(preview: DataFrame, limit: int = 10) -> DataFrame:
    """Count and sum per vendor, the largest outflows first."""
    return (preview.groupBy("counterparty")
            .agg(F.count("amount").alias("transaction_count"),
                 money_sum("amount").alias("total_amount"))
            .orderBy("total_amount", "counterparty").limit(limit))
