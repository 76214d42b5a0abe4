"""Reporting rules on hand-written rows."""

from tillflow.operators import etl, reports

DEPOSIT = ("platform string, date_time timestamp, settlement_id bigint, order_id string, "
           "quantity bigint, product_sales double, shipping_credits double, "
           "gift_wrap_credits double, promotional_rebates double, marketplace_tax double, "
           "selling_fees double, fba_fees double, other_transaction_fees double, total double")


def deposit(platform, day, settlement, order, sales, fee, total, quantity=1):
    return (platform, f"{day} 12:30:00", settlement, order, quantity, sales, 0.0, 0.0, 0.0, 0.0,
            fee, -1.0, 0.0, total)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_revenue_rate_is_signed_and_null_without_gross(frame):
    df = frame(DEPOSIT, deposit("Amazon", "2024-01-01", 1, "a", 100.0, -14.0, 85.0),
               deposit("Amazon", "2024-01-01", 1, "a", 100.0, -14.0, 85.0),
               deposit("Etsy", "2024-01-01", 2, "b", 0.0, -1.0, -2.0))
    amazon, etsy = rows(reports.revenue_by_channel(df))
    assert str(amazon["cash_date"]) == "2024-01-03"
    assert (amazon["order_count"], amazon["units_sold"]) == (1, 2)
    assert amazon["effective_fee_rate_pct"] == -15.0
    assert etsy["cash_flow_category"] == "Operating Inflows - Revenue - Other"
    assert etsy["effective_fee_rate_pct"] is None


def test_date_range_is_inclusive(frame):
    df = frame(DEPOSIT, *[deposit("Amazon", f"2024-01-0{d}", 1, "a", 1.0, 0.0, 1.0)
                          for d in (1, 2, 3, 4)])
    out = reports.revenue_by_channel(df, "2024-01-02", "2024-01-03")
    assert [str(r["cash_date"]) for r in rows(out)] == ["2024-01-05", "2024-01-04"]


def test_fee_total_skips_lines_with_a_null_fee(frame):
    df = frame(DEPOSIT, deposit("Amazon", "2024-01-01", 1, "a", 9.0, -2.0, 6.0),
               deposit("Amazon", "2024-01-01", 1, "b", 9.0, None, 8.0))
    row = rows(reports.cogs_and_fees(df))[0]
    assert (row["platform_selling_fees"], row["fulfillment_fees"]) == (2.0, 2.0)
    assert row["total_fees"] == 3.0


INVOICE = ("invoice_id string, vendor string, invoice_date date, invoice_number string, "
           "po_number string, subtotal double, sales_tax double, total double")


def vendors(spark):
    return spark.createDataFrame(
        [("Acme", "Net 15", 12, 20), ("Bolt", None, None, 45), ("Core", "Net 60", None, None)],
        "Name string, Terms string, `Actual Days` bigint, `Request Days` bigint")


def invoices(frame):
    return frame(INVOICE, ("i1", "Acme", "2024-01-01", "1", "P1", 10.0, 1.0, 11.0),
                 ("i2", "Bolt", "2024-01-01", "2", None, 20.0, 0.0, 20.0),
                 ("i3", "Core", "2024-01-01", "3", None, 30.0, 0.0, 30.0),
                 ("i4", "Nobody", "2024-01-01", "4", None, 40.0, 0.0, 40.0),
                 (None, "Acme", "2024-01-02", "5", None, 5.0, 0.0, 5.0),
                 ("i6", "Acme", None, "6", None, 5.0, 0.0, 5.0),
                 ("i7", "Acme", "2024-01-03", "7", None, -5.0, 0.0, -5.0))


def test_payment_days_fall_back_to_request_then_thirty(frame, spark):
    out = rows(reports.vendor_payments(invoices(frame), vendors(spark), "2024-01-01", "2024-01-01"))
    assert {(r["vendor"], str(r["cash_date"])) for r in out} == {
        ("Acme", "2024-01-13"), ("Bolt", "2024-02-15"), ("Core", "2024-01-31"),
        ("Nobody", "2024-01-31")}
    assert {r["payment_terms"] for r in out} == {"Net 15", None, "Net 60"}


def test_commitments_price_and_skip_received_lines(frame, spark):
    po = frame("po_no string, order_date date, status string, vendor string, sku string, "
               "qty_ordered bigint, qty_received bigint",
               ("p1", "2024-01-01", "Open", "Acme", "a", 10, 4),
               ("p1", "2024-01-01", "Open", "Acme", "b", 2, None),
               ("p2", "2024-01-01", "Open", "Acme", "unknown", 1, 0),
               ("p3", "2024-01-01", "Open", "Acme", "a", 5, 5),
               ("p4", "2024-01-01", "Closed", "Acme", "a", 5, 0))
    item = frame("sku string, item_price double, build_cost double", ("a", 3.0, 1.0),
                 ("b", None, 2.5))
    row = rows(reports.purchase_commitments(po, item, vendors(spark)))[0]
    assert (row["cash_amount"], row["units"], row["po_count"], row["line_count"]) == (-23.0, 9, 2, 3)
    assert (str(row["estimated_delivery_date"]), str(row["cash_date"])) == ("2024-01-31", "2024-02-12")


def test_statement_balances_chain(frame, spark):
    dep = frame(DEPOSIT, deposit("Amazon", "2024-01-01", 1, "a", 100.0, 0.0, 90.0),
                deposit("Etsy", "2024-01-02", 1, "a", 100.0, 0.0, 50.0))
    ref = frame(DEPOSIT, deposit("Amazon", "2024-01-01", 1, "a", -10.0, 0.0, -10.0))
    out = rows(reports.consolidated_cash_flow(dep, ref, invoices(frame), vendors(spark),
                                              starting_balance=1000.0))
    ordered = sorted(out, key=lambda r: (str(r["cash_date"]), r["cash_flow_section"],
                                         r["cash_flow_category"]))
    before = 1000.0
    for row in [r for r in ordered if r["cash_date"] is not None]:
        if str(row["cash_date"]) != "None":
            assert row["ending_cash_balance"] == row["beginning_cash_balance"] + row["cash_amount"]
    assert sum(r["cash_amount"] for r in out) + before == max(
        out, key=lambda r: (str(r["cash_date"] or ""), r["cash_flow_section"]))["ending_cash_balance"]


def test_early_aggregation_keeps_vendor_copies(frame, spark):
    """A vendor listed twice multiplies its invoices, before and after."""
    twice = vendors(spark).unionByName(vendors(spark).where("Name = 'Acme'"))
    out = rows(reports.vendor_outflows(invoices(frame), twice, "2024-01-01", "2024-01-01"))
    assert {r["platform"]: r["cash_amount"] for r in out}["Acme"] == -22.0


def test_settlements(frame):
    df = frame(DEPOSIT, deposit("Amazon", "2024-01-01", 1, "a", 10.0, 0.0, 9.0, 2),
               deposit("Amazon", "2024-01-05", 1, "b", 10.0, 0.0, 9.0, 3),
               deposit("Etsy", "2024-01-05", 1, "b", 10.0, 0.0, 7.0),
               deposit("Amazon", "2024-01-05", 2, "c", 5.0, 0.0, 5.0),
               deposit("Amazon", "2024-01-06", 2, "c", -5.0, 0.0, -5.0))
    settled = etl.settle_deposits(df)
    found = {(r["platform"], r["settlement_id"]): r for r in rows(settled)}
    assert set(found) == {("Amazon", 1), ("Etsy", 1)}  # the zero settlement is gone
    assert str(found["Amazon", 1]["cash_date"]) == "2024-01-07"
    assert str(found["Etsy", 1]["cash_date"]) == "2024-01-05"
    ledger = {r["counterparty"]: r for r in rows(etl.deposits_to_ledger(settled))}
    amazon = ledger["Amazon"]
    assert len(amazon) == 26
    assert amazon["description"] == "Amazon Settlement 1 (2 orders, 5 units)"
    assert amazon["notes"] == "Gross: $20.00, Fees: $2.00, Net: $18.00"
    assert amazon["tags"] == ["Amazon", "ecommerce", "revenue"]
    assert ledger["Etsy"]["cash_flow_category"] == "Revenue - Etsy"
    assert len(amazon["transaction_id"]) == 36


def test_invoice_load_skips_credits_undated_and_unidentified(frame, spark):
    loaded = rows(etl.invoices_to_ledger(invoices(frame), vendors(spark), ids="hash"))
    assert sorted(r["source_id"] for r in loaded) == ["i1", "i2", "i3", "i4"]
    first = next(r for r in loaded if r["source_id"] == "i1")
    assert (first["amount"], first["description"]) == (-11.0, "Invoice 1 (PO: P1)")
    assert first["notes"] == "Payment terms: Net 15, Due: 2024-01-13, Subtotal: $10.00, Tax: $1.00"
    preview = rows(etl.invoices_preview(invoices(frame), vendors(spark)))
    assert len(preview) == 5  # the one without an id is previewed
    assert {(r["total_count"], r["total_amount"]) for r in preview} == {(5, 106.0)}
    smallest = rows(etl.invoices_preview_summary(etl.invoices_preview(invoices(frame), vendors(spark))))
    assert [r["counterparty"] for r in smallest] == ["Nobody", "Core", "Bolt", "Acme"]


def test_hash_ids_repeat(frame, spark):
    once = etl.invoices_to_ledger(invoices(frame), vendors(spark), ids="hash")
    ids = lambda: {r["transaction_id"] for r in once.collect()}
    assert ids() == ids()
