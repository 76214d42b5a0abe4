"""The warehouse's source tables as views over the TPC-H-like test tables.

``FIXTURES.md`` states each definition.  Everything here is lazy and
column-pruned by Catalyst: an operator that needs three columns of
``deposits`` reads only the Parquet columns behind those three.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.dates import DateLike, month_start, next_weekday
from tillflow.functions.money import from_units, units
from tillflow.functions.partitions import spread
from tillflow.operators import etl
from tillflow.operators.debt import loan_schedule

FIRST_LOAN_START = "1995-01-01"


def _choose(key: Column, values: list, default=None) -> Column:
    """``values[key]`` for key 0, 1, 2, ... as a CASE."""
    out = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(key == i, v) if out is None else out.when(key == i, v)
    return out if default is None else out.otherwise(F.lit(default))


def _platform(last: str) -> str:
    """Sales channel by order priority; ``last`` names the fifth."""
    return ("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Amazon' WHEN '2' THEN 'Shopify' "
            f"WHEN '3' THEN 'TikTok' WHEN '4' THEN 'Wholesale' ELSE '{last}' END")


def _supplier_name(key: Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


class TestTables:
    """Source tables of one test-data folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One of the given tables; its footer is read once."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    # ---- sales ------------------------------------------------------------

    @cached_property
    def sales_lines(self) -> DataFrame:
        """Every sales line with platform, components and its return flag."""
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        lines = self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        money = {
            "product_sales": "l_extendedprice",
            "shipping_credits": "l_extendedprice * l_tax",
            "gift_wrap_credits": "CASE WHEN l_linenumber = 7 THEN 1.5D ELSE 0.0D END",
            "promotional_rebates": "-l_extendedprice * l_discount",
            "selling_fees": "CASE WHEN l_linenumber <> 6 THEN l_extendedprice * -0.15D END",
            "fba_fees": "l_extendedprice * -0.05D",
            "other_transaction_fees": "-0.3D",
        }
        exact = {name: f"CAST(rint(({text}) * 10000D) AS BIGINT)" for name, text in money.items()}
        total = " + ".join(f"coalesce({text}, 0L)" for text in exact.values())
        taxes = ["product_sales_tax", "shipping_credits_tax", "gift_wrap_credits_tax",
                 "promotional_rebate_tax", "marketplace_tax"]
        return lines.selectExpr(
            _platform("Whiskey") + " AS platform",
            "l_shipdate AS date_time",
            "CAST(year(l_shipdate) * 1000 + floor(dayofyear(l_shipdate) / 14) AS BIGINT) AS settlement_id",
            "'Order' AS type",
            "CAST(l_orderkey AS STRING) AS order_id",
            "CAST(l_partkey AS STRING) AS sku",
            "'Sale' AS description",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "'web' AS marketplace",
            "'Merchant' AS fulfillment",
            *[f"CAST({text} AS DOUBLE) / 10000D AS {name}" for name, text in exact.items()],
            *[f"0.0D AS {name}" for name in taxes],
            f"CAST({total} AS DOUBLE) / 10000D AS total",
            "o_custkey AS customer_id",
            "CAST(l_linenumber AS BIGINT) AS order_line_id",
            "l_returnflag AS return_flag",
        )

    @cached_property
    def deposits(self) -> DataFrame:
        return self.sales_lines.where("return_flag <> 'R'")

    @cached_property
    def refunds(self) -> DataFrame:
        money = ["product_sales", "shipping_credits", "gift_wrap_credits",
                 "promotional_rebates", "selling_fees", "fba_fees",
                 "other_transaction_fees", "total"]
        lines = self.sales_lines.where("return_flag = 'R'")
        # 0 - x, not -x: the negative of 0.0 would be -0.0
        return lines.withColumns({c: 0.0 - F.col(c) for c in money})

    @cached_property
    def fees(self) -> DataFrame:
        return self.sales_lines

    @cached_property
    def sales_orders(self) -> DataFrame:
        return self.sales_lines.select(
            "platform", "date_time", "settlement_id", "order_id", "sku", "quantity",
            "fulfillment", "product_sales", "shipping_credits", "promotional_rebates",
            "selling_fees", "fba_fees", "other_transaction_fees", "total",
            "customer_id", "order_line_id")

    @cached_property
    def sku_forecast(self) -> DataFrame:
        return (self.sales_lines
                .groupBy(month_start(F.to_date("date_time")).alias("month"), "sku", "platform")
                .agg(F.sum("quantity").alias("forecast_units"),
                     from_units(F.sum(units("product_sales"))).alias("forecast_revenue")))

    # ---- purchasing -------------------------------------------------------

    @cached_property
    def vendors(self) -> DataFrame:
        """Suppliers but for one in ten, so that some invoices find no vendor."""
        key = F.col("s_suppkey")
        return self.raw("supplier").where(key % 10 != 9).select(
            F.col("s_name").alias("Name"),
            _choose(key % 4, ["Net 30", "Net 15", "Net 60"]).alias("Terms"),
            F.when(key % 3 != 0, 10 + key % 50).alias("Actual Days"),
            F.when(key % 6 != 0, F.lit(30).cast("bigint")).alias("Request Days"))

    @cached_property
    def item(self) -> DataFrame:
        key, price = F.col("p_partkey"), F.col("p_retailprice")
        return self.raw("part").select(
            key.cast("string").alias("sku"),
            F.col("p_name").alias("product"),
            F.when(key % 5 != 0, price).alias("item_price"),
            F.when(key % 25 != 0, from_units(units(price * 0.6))).alias("build_cost"))

    @cached_property
    def invoices(self) -> DataFrame:
        ext = units("l_extendedprice")
        tax = units(F.col("l_extendedprice") * F.col("l_tax"))
        signed = F.when(F.col("l_returnflag") == "R", -(ext + tax)).otherwise(ext + tax)
        order = F.col("l_orderkey").cast("string")
        return self.raw("lineitem").where("l_linestatus = 'F'").select(
            F.when(F.col("l_linenumber") != 7,
                   F.concat_ws("-", order, F.col("l_linenumber").cast("string"),
                               F.col("l_partkey").cast("string"))).alias("invoice_id"),
            _supplier_name(F.col("l_suppkey")).alias("vendor"),
            F.when(F.col("l_quantity") != 50, F.to_date("l_shipdate")).alias("invoice_date"),
            F.concat(F.lit("INV-"), order).alias("invoice_number"),
            F.when(F.col("l_returnflag") == "N",
                   F.concat(F.lit("PO-"), order)).alias("po_number"),
            F.col("l_extendedprice").alias("subtotal"),
            from_units(tax).alias("sales_tax"),
            from_units(signed).alias("total"))

    @cached_property
    def po_line_item(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
        lines = self.raw("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        ordered = F.col("l_quantity").cast("bigint")
        return lines.select(
            F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("po_no"),
            F.to_date("o_orderdate").alias("order_date"),
            F.when(F.col("o_orderstatus") == "O", "Open")
             .when(F.col("o_orderstatus") == "F", "Closed")
             .otherwise("Partial").alias("status"),
            _supplier_name(F.col("l_suppkey")).alias("vendor"),
            F.col("l_partkey").cast("string").alias("sku"),
            ordered.alias("qty_ordered"),
            F.when(F.col("l_returnflag") == "A", ordered)
             .when(F.col("l_returnflag") == "R", F.lit(5).cast("bigint")).alias("qty_received"))

    # ---- balances and accounts --------------------------------------------

    @staticmethod
    def _account_type() -> Column:
        segment = F.col("c_mktsegment")
        return (F.when(segment == "AUTOMOBILE", "Checking")
                .when(segment == "BUILDING", "Money Market")
                .when(segment == "FURNITURE", "LOC")
                .when(segment == "HOUSEHOLD", "Credit Card")
                .otherwise("Savings"))

    @cached_property
    def cash_balances(self) -> DataFrame:
        """One balance per month and account type."""
        customers = self.raw("customer").select("c_custkey", self._account_type().alias("account_type"))
        orders = self.raw("orders").select("o_custkey", "o_orderdate", "o_totalprice")
        balance = F.sum(units("o_totalprice"))
        is_loc = F.col("account_type") == "LOC"
        return (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
                .groupBy(month_start(F.to_date("o_orderdate")).alias("balance_date"), "account_type")
                .agg(balance.alias("whole"))
                .select("balance_date",
                        F.concat(F.lit("acct-"), F.col("account_type")).alias("bank_account_id"),
                        F.col("account_type").alias("bank_account_name"),
                        "account_type",
                        from_units(F.col("whole")).alias("ending_balance"),
                        F.when(is_loc, F.lit(500000.0)).alias("credit_limit"),
                        F.when(is_loc, from_units(5_000_000_000 - F.col("whole")))
                         .alias("available_credit"),
                        F.lit(False).alias("is_forecast")))

    @cached_property
    def bank_accounts(self) -> DataFrame:
        """One account per customer."""
        kind = self._account_type()
        credit = kind.isin("LOC", "Credit Card")
        return self.raw("customer").select(
            F.concat(F.lit("acct-"), F.col("c_custkey").cast("string")).alias("account_id"),
            F.col("c_name").alias("account_name"),
            kind.alias("account_type"),
            F.concat(F.lit("Bank "), F.col("c_nationkey").cast("string")).alias("institution_name"),
            credit.alias("is_credit_line"),
            F.abs("c_acctbal").alias("credit_limit"),
            (F.col("c_custkey") % 13 != 0).alias("is_active"))

    @cached_property
    def payment_terms(self) -> DataFrame:
        """One payment rule per supplier."""
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            F.concat(F.lit("term-"), key.cast("string")).alias("term_id"),
            F.concat(F.lit("Terms of "), F.col("s_name")).alias("term_name"),
            _choose(key % 6, ["settlement", "daily", "net_terms", "immediate", "credit_card"],
                    "net_terms").alias("cycle_type"),
            F.when(key % 6 == 1, F.lit(2).cast("bigint")).when(key % 6 == 2, key % 61)
             .when(key % 6 == 3, F.lit(0).cast("bigint"))
             .when(key % 6 == 4, F.lit(30).cast("bigint")).alias("lag_days"),
            F.when(key % 6 == 0, F.lit(14).cast("bigint")).alias("settlement_period_days"),
            F.when(key % 6 == 0, F.lit(2).cast("bigint"))
             .when(key % 12 == 5, F.lit(15).cast("bigint")).alias("settlement_lag_days"),
            F.when(key % 6 == 1, F.array(F.lit("Tuesday"), F.lit("Friday"))).alias("payout_days"),
            F.when(key % 12 == 4, F.lit(31).cast("bigint")).alias("payout_day_of_month"),
            F.when(key % 24 == 11, "with_settlement").when(key % 24 == 23, "with_payout")
             .when(key % 24 == 6, "with_settlement").otherwise("own").alias("payment_timing"),
            _choose(key % 3, ["Next Business Day", "Previous Business Day"], "No Adjustment")
            .alias("weekend_handling"))

    @cached_property
    def scenarios(self) -> DataFrame:
        """One planning scenario per supplier."""
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            F.concat(F.lit("plan-"), key.cast("string")).alias("scenario_id"),
            F.concat(F.lit("Plan "), F.col("s_name")).alias("scenario_name"),
            _choose(key % 4, ["Base", "Best", "Worst"], "Custom").alias("scenario_type"),
            (F.col("s_acctbal") / 100000.0).alias("revenue_growth_rate"),
            F.when(key % 6 != 0, (key % 7) / 100.0).alias("expense_inflation_rate"),
            F.when(key % 5 == 0, F.lit('{"revenue_factor": 1.25, "note": "campaign"}')).alias("custom_assumptions"),
            (key % 9 != 0).alias("is_active"))

    @cached_property
    def scenario_requests_stored(self) -> DataFrame:
        """One requested scenario per customer, most of them stored plans."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            F.concat(F.lit("req-"), key.cast("string")).alias("request_id"),
            F.when(key % 10 == 0, "best").when(key % 10 != 1, F.concat(F.lit("plan-"), (key % 500).cast("string")))
             .alias("scenario"))

    @cached_property
    def recurring_items(self) -> DataFrame:
        """One recurring item per customer, over all frequencies and intervals."""
        key = F.col("c_custkey")
        frequency = _choose(key % 6, ["Daily", "Weekly", "Monthly", "Quarterly", "Annually"])
        start = F.date_add(F.lit("1996-01-01").cast("date"), (key % 900).cast("int"))
        return self.raw("customer").select(
            F.concat(F.lit("item-"), key.cast("string")).alias("recurring_id"),
            F.concat(F.lit("Charge to "), F.col("c_name")).alias("transaction_name"),
            _choose(key % 3, ["OpEx - Rent", "Debt Service"], "OpEx - Insurance").alias("cash_flow_category"),
            (0.0 - F.abs("c_acctbal")).alias("amount"), frequency.alias("frequency"),
            (1 + F.floor(key / 6) % 3).cast("bigint").alias("recurrence_interval"),
            F.when(key % 4 != 0, 1 + key % 7).alias("day_of_week"),
            F.when((key % 7 != 0) | (key % 6).isin(2, 5), 1 + key % 31).alias("day_of_month"),
            F.when(key % 5 != 0, 1 + key % 12).alias("month_of_year"),
            start.alias("start_date"),
            F.when(key % 8 == 0, F.date_add(F.lit("1998-07-10").cast("date"), (key % 60).cast("int"))).alias("end_date"),
            (key % 11 != 0).alias("is_active"))

    @cached_property
    def scenario_requests(self) -> DataFrame:
        """One requested scenario per customer, some of them unknown."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            F.concat(F.lit("req-"), key.cast("string")).alias("request_id"),
            _choose(key % 5, ["base", "best", "worst", "stress"]).alias("scenario"))

    @cached_property
    def recurring_transactions(self) -> DataFrame:
        """One recurring item per supplier, on every day of the month."""
        key = F.col("s_suppkey")
        category = _choose(key % 5, ["OpEx - Rent", "OpEx - Software", "Debt Service",
                                     "Bank Loan Fees"], "OpEx - Insurance")
        return self.raw("supplier").select(
            F.concat(F.lit("rec-"), key.cast("string")).alias("recurring_id"),
            F.concat(F.lit("Charge of "), F.col("s_name")).alias("transaction_name"),
            category.alias("cash_flow_category"),
            (0.0 - F.abs("s_acctbal")).alias("amount"),
            F.lit("Monthly").alias("frequency"),
            F.lit(1).cast("bigint").alias("recurrence_interval"),
            (1 + key % 31).alias("day_of_month"),
            F.date_add(F.lit("1997-01-01").cast("date"), (key % 700).cast("int")).alias("start_date"),
            F.when(key % 4 == 0,
                   F.date_add(F.lit("1998-01-01").cast("date"), (key % 365).cast("int")))
             .alias("end_date"),
            (key % 11 != 0).alias("is_active"))

    # ---- loans ------------------------------------------------------------

    @cached_property
    def loans(self) -> DataFrame:
        """One loan per customer, over all payment structures."""
        key = F.col("c_custkey")
        kind = key % 5
        balance = (F.rint(F.abs("c_acctbal") * 1000) + 500000) / 100.0
        slow = key % 7 == 0
        fixed = (F.when(kind == 3, F.floor(balance * 0.65).cast("double") / 100.0)
                 .when(kind.isin(2, 4) & slow, F.floor(balance * 0.4).cast("double") / 100.0)
                 .when(kind.isin(2, 4), F.floor(balance * 2.5).cast("double") / 100.0))
        start = F.date_add(F.lit(FIRST_LOAN_START).cast("date"), (key % 1500).cast("int"))
        no_months = F.lit(0)
        return self.raw("customer").select(
            F.concat(F.lit("loan-"), key.cast("string")).alias("loan_id"),
            F.concat(F.lit("Loan of "), F.col("c_name")).alias("loan_name"),
            F.concat(F.lit("Bank "), F.col("c_nationkey").cast("string")).alias("lender"),
            F.lit("Term Loan").alias("loan_type"),
            balance.alias("original_amount"),
            balance.alias("current_balance"),
            _choose(key % 8, [0.0, 0.0725, 0.1075, 0.116516, 0.115, 0.065, 0.0499], 0.09)
            .alias("annual_rate"),
            (1 + key % 31).cast("int").alias("payment_day"),
            start.alias("start_date"),
            F.add_months(start, 60).alias("maturity_date"),
            (F.when(kind == 0, "1").when(kind == 1, "2").when(kind == 3, "4").otherwise("3"))
            .alias("structure_choice"),
            F.when(kind == 0, F.lit(24)).when(kind == 4, F.lit(6)).otherwise(no_months)
             .alias("io_months"),
            F.when(kind == 0, F.lit(36)).when(kind == 1, F.lit(60)).otherwise(no_months)
             .alias("amort_months"),
            fixed.alias("fixed_payment"),
            F.when(kind == 3, F.floor(balance * 90).cast("double") / 100.0).alias("balloon_amount"),
            F.add_months(start, 24).alias("io_end_date"))

    @cached_property
    def credit_lines(self) -> DataFrame:
        """The loans as revolving lines with a spread over the base rate."""
        key = F.regexp_extract("loan_id", "[0-9]+", 0).cast("bigint")
        return self.loans.withColumn("spread", (key % 4) / 100.0)

    @cached_property
    def credit_movements(self) -> DataFrame:
        """Draws and repayments on the lines: one per order of the customer."""
        amount = F.expr("floor(o_totalprice * 5 + 0.5D) / 100.0D")
        return self.raw("orders").select(
            F.concat(F.lit("loan-"), F.col("o_custkey").cast("string")).alias("loan_id"),
            F.to_date("o_orderdate").alias("movement_date"),
            F.when(F.col("o_orderkey") % 3 == 0, 0.0 - amount).otherwise(amount).alias("amount"))

    @cached_property
    def base_rates(self) -> DataFrame:
        """A base rate that changes on the first order day of every fifth month, and in mid-month."""
        day = F.to_date("o_orderdate")
        months = F.year(day) * 12 + F.month(day)
        change = self.raw("orders").where(months % 5 == 0).groupBy(months.alias("m")).agg(F.min(day).alias("d"))
        return change.select(F.when(F.col("m") % 2 == 0, F.col("d")).otherwise(F.date_add("d", 14)).alias("effective_date"),
                             (0.05 + (F.col("m") % 9) / 400.0).alias("base_rate"))

    def debt_schedule(self, as_of: DateLike) -> DataFrame:
        return loan_schedule(self.loans, as_of)

    # ---- accounting -------------------------------------------------------

    @cached_property
    def chart_of_accounts(self) -> DataFrame:
        """One account per part; half of them children of a brand account."""
        key = F.col("p_partkey")
        leaf = F.concat(F.initcap("p_name"), F.lit(" "), key.cast("string"))
        return self.raw("part").select(
            F.when(key % 3 == 0, (4000 + key).cast("string"))
             .when(key % 50 == 1, "Draws").alias("account_number"),
            F.when(key % 2 == 0, F.concat(F.col("p_brand"), F.lit(":"), leaf))
             .otherwise(leaf).alias("full_name"),
            F.when(key % 4 == 0, "Income").otherwise("Expenses").alias("account_type"),
            F.lit("General").alias("detail_type"),
            F.when(key % 6 == 0, F.lit("Ads, cards, and other")).alias("description"),
            F.lit("USD").alias("currency"))

    @cached_property
    def category_map(self) -> DataFrame:
        """Rules for four in five accounts; some are listed in two directions."""
        key = F.col("p_partkey")
        leaf = F.concat(F.initcap("p_name"), F.lit(" "), key.cast("string"))
        section = _choose(key % 8, ["operating_inflows", "operating_outflows", "cogs",
                                    "investing_outflows", "financing_inflows",
                                    "financing_outflows", "non_cash_items"], "operating_outflows")
        base = self.raw("part").where(key % 5 != 4).select(
            section.alias("section"),
            leaf.alias("account"),
            F.when(key % 3 == 0, (4000 + key).cast("string")).alias("account_number"),
            F.concat(F.lit("Category "), F.col("p_size").cast("string")).alias("category"),
            F.col("p_type").alias("subcategory"),
            F.when(key % 8 != 6, F.lit("immediate")).alias("cash_timing"))
        twice = (base.where("section = 'financing_inflows'")
                 .withColumn("section", F.lit("financing_outflows"))
                 .withColumn("category", F.concat(F.col("category"), F.lit(" repaid"))))
        return base.unionByName(twice)

    @cached_property
    def gl_transactions(self) -> DataFrame:
        """One general-ledger row per sales line, booked on its part's account."""
        parts = self.raw("part").select("p_partkey", "p_name")
        key = F.col("l_partkey")
        leaf = F.concat(F.initcap("p_name"), F.lit(" "), key.cast("string"))
        amount = F.when(F.col("l_returnflag") == "R", 0.0 - F.col("l_extendedprice")) \
                  .otherwise(F.col("l_extendedprice"))
        return (self.raw("lineitem").join(parts, key == F.col("p_partkey"), "left")
                .select(
                    F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                F.col("l_linenumber").cast("string"), key.cast("string"))
                    .alias("entry_id"),
                    F.to_date("l_shipdate").alias("transaction_date"),
                    F.when(key % 3 == 0, (4000 + key).cast("string")).alias("account_number"),
                    leaf.alias("account_name"),
                    amount.alias("amount"),
                    _supplier_name(F.col("l_suppkey")).alias("vendor"),
                    F.lit("Journal Entry").alias("transaction_type")))

    @cached_property
    def budget(self) -> DataFrame:
        """Budgets by platform, from all orders: monthly, quarterly and annual rows.

        Odd start months have a second version, raised by a tenth; every third start month
        has a third one that is not active.
        """
        platform = F.concat(F.lit("Revenue - "), F.expr(_platform("Outlet")))
        day = F.to_date("o_orderdate")
        grains = F.inline(F.array(*[
            F.struct(F.lit(kind).alias("period_type"), F.trunc(day, unit).alias("period_start_date"))
            for kind, unit in (("Monthly", "MM"), ("Quarterly", "QUARTER"), ("Annual", "YEAR"))]))
        sums = (self.raw("orders").select(grains, platform.alias("cash_flow_category"), "o_totalprice")
                .groupBy("period_type", "period_start_date", "cash_flow_category")
                .agg(F.sum(units("o_totalprice")).alias("whole")))
        month = F.month("period_start_date")

        def version(number: int, whole: Column, active: bool) -> Column:
            return F.struct(F.lit(number).cast("bigint").alias("version"), from_units(whole).alias("budget_amount"),
                            F.lit(active).alias("is_active"))

        none = F.lit(None)
        versions = F.array_compact(F.array(
            version(1, F.col("whole"), True),
            F.when(month % 2 == 1, version(2, F.expr("whole * 11 div 10"), True)).otherwise(none),
            F.when(month % 3 == 0, version(3, F.lit(10_000), False)).otherwise(none)))
        return sums.select(
            F.concat_ws("-", F.lit("budget"), "period_type", F.col("period_start_date").cast("string"),
                        "cash_flow_category").alias("budget_id"),
            F.year("period_start_date").cast("bigint").alias("fiscal_year"), "period_type", "period_start_date",
            F.lit("Operating").alias("cash_flow_section"), "cash_flow_category", F.inline(versions))

    @cached_property
    def payout_lines(self) -> DataFrame:
        """Processor payout report: purchases, paid two days later."""
        day = F.to_date("ts")
        payout = next_weekday(F.date_add(day, 2))
        fee = units(F.col("value") * 0.03)
        return self.raw("events").where("event_type = 'purchase'").select(
            F.col("ts").alias("transaction_time"),
            F.lit("charge").alias("type"),
            F.concat(F.lit("#"), F.col("event_id").cast("string")).alias("order"),
            F.lit("paid").alias("payout_status"),
            payout.alias("payout_date"),
            F.concat(F.lit("payout-"), payout.cast("string")).alias("payout_id"),
            F.col("value").alias("amount"),
            from_units(fee).alias("fee"),
            from_units(units("value") - fee).alias("net"))

    @cached_property
    def channel_events(self) -> DataFrame:
        """Settlements by return flag, and payouts of two of the three flags, with gaps."""
        lines = self.raw("lineitem").select(F.col("l_returnflag").alias("channel"), F.to_date("l_shipdate").alias("day"))
        settled = (lines.groupBy("channel", F.year("day").alias("y"), F.floor(F.dayofyear("day") / 14).alias("p"))
                   .agg(F.max("day").alias("last")))
        settled = settled.select("channel", F.lit("settlement").alias("event_kind"),
                                 F.date_add("last", 2).alias("event_date"))
        paid = lines.where("channel <> 'N' AND dayofmonth(day) % 5 = 0 AND month(day) NOT IN (7, 8)").select(
            "channel", F.lit("payout").alias("event_kind"), next_weekday(F.date_add("day", 2)).alias("event_date"))
        return settled.unionByName(paid)

    # ---- ledger -----------------------------------------------------------

    @cached_property
    def actual_ledger(self) -> DataFrame:
        """Deposits and invoices as ledger rows with content-hash ids."""
        deposits = etl.deposits_to_ledger(etl.settle_deposits(self.deposits), ids="hash")
        invoices = etl.invoices_to_ledger(self.invoices, self.vendors, ids="hash")
        return deposits.unionByName(invoices)

    @cached_property
    def planned_ledger(self) -> DataFrame:
        """Open orders as forecast rows of the three scenarios."""
        key = F.col("o_orderkey")
        outflow = key % 4 == 0
        cash_date = F.date_add(F.to_date("o_orderdate"), 90)
        orders = self.raw("orders").where("o_orderstatus = 'O'").select(
            F.concat(F.lit("plan-"), key.cast("string")).alias("transaction_id"),
            cash_date.alias("cash_date"),
            F.lit("Operating").alias("cash_flow_section"),
            F.when(outflow, "Operating Expenses").otherwise("Revenue - Ecommerce")
             .alias("cash_flow_category"),
            F.when(outflow, 0.0 - F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
             .alias("amount"),
            F.concat(F.lit("Planned order "), key.cast("string")).alias("description"),
            F.lit(True).alias("is_forecast"),
            _choose(key % 3, ["base", "best"], "worst").alias("scenario_id"),
            F.lit("forecast").alias("source_system"))
        return etl.as_ledger(orders.withColumn("transaction_date", F.col("cash_date")))

    @cached_property
    def ledger(self) -> DataFrame:
        return self.actual_ledger.unionByName(self.planned_ledger)

    def loan_config_lines(self) -> DataFrame:
        """The loans as text lines of flat config files, one file per loan."""
        fields = ["loan_id", "loan_name", "lender", "loan_type", "original_amount",
                  "current_balance", "annual_rate", "payment_day", "start_date",
                  "maturity_date", "structure_choice", "io_months", "amort_months",
                  "fixed_payment", "balloon_amount"]
        text = {"loan_id", "loan_name", "lender", "loan_type", "start_date",
                "maturity_date", "structure_choice"}

        def line(name: str) -> Column:
            value = F.coalesce(F.col(name).cast("string"), F.lit("null"))
            if name in text:
                value = F.concat(F.lit('"'), value, F.lit('"'))
            return F.concat(F.lit(f"{name}: "), value, F.lit("  # note"))

        lines = F.array(F.lit("# Loan configuration"), F.lit(""), *[line(n) for n in fields])
        return spread(self.loans, "loan_id").select(F.col("loan_id").alias("file"), F.explode(lines).alias("value"))

    def coa_lines(self) -> DataFrame:
        """The chart of accounts as the lines of its CSV export."""
        def field(name: str) -> Column:
            value = F.coalesce(F.col(name), F.lit(""))
            return F.when(value.contains(","), F.concat(F.lit('"'), value, F.lit('"'))) \
                    .otherwise(value)

        body = self.chart_of_accounts.select(F.concat_ws(",", *[
            field(c) for c in ("account_number", "full_name", "account_type", "detail_type",
                               "description", "currency")]).alias("value"))
        frame = self.spark.createDataFrame(
            [("Account List,,,,,",), ("Example Inc.,,,,,",), ("",),
             ("Account #,Full name,Type,Detail type,Description,Currency",),
             ("TOTAL,,,,,",), ("",),
             ('" Monday, January 5, 1998 09:00 AM GMT-08:00",,,,,',)], "value string")
        return frame.unionByName(body)

    def payout_csv_lines(self) -> DataFrame:
        """The payout report as CSV lines, times written with an offset."""
        columns = [F.concat(F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss"),
                            F.lit(" -0600")),
                   F.col("type"), F.col("order"), F.lit("visa"), F.lit("online"),
                   F.col("payout_status"), F.col("payout_date").cast("string"),
                   F.col("payout_id"), F.col("payout_date").cast("string"),
                   *[F.col(c).cast("decimal(18,4)").cast("string") for c in ("amount", "fee", "net")],
                   F.lit("#1"), F.lit("card"), F.col("amount").cast("string"),
                   F.lit("USD"), F.lit("USD")]
        return self.payout_lines.select(F.concat_ws(",", *columns).alias("value"))


