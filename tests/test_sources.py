"""Readers, file sources, rules and seeds."""

import datetime as dt

import pytest

from tillflow.schemas import TABLES, fill_missing
from tillflow.sources import files, rules, seeds
from tillflow.sources.warehouse import Warehouse

COA = '''Account List,,,,,
Example Inc.,,,,,

Account #,Full name,Type,Detail type,Description,Currency
1071,Clearing,Bank,Cash on hand,,USD
6010,Marketing:Ads,Expenses,Advertising,"Ads, cards, and other",USD
Draws,Equity:Owner,Equity,Owner's Equity,,USD
TOTAL,,,,,

" Monday, January 5, 1998 09:00 AM GMT-08:00",,,,,
'''

PAYOUTS = '''Transaction Date,Type,Order,Card Brand,Card Source,Payout Status,Payout Date,Payout ID,Available On,Amount,Fee,Net,Checkout,Payment Method Name,Presentment Amount,Presentment Currency,Currency
2026-02-22 20:30:00 -0600,charge,#1,visa,online,paid,2026-02-24,77,2026-02-24,49.41,1.41,48.00,#9,card,49.41,USD,USD
2026-02-20 10:00:00 -0600,charge,#2,visa,online,paid,2026-02-24,77,2026-02-24,10.00,0.50,9.50,#9,card,10.00,USD,USD
'''


def test_account_list_drops_preamble_and_trailer(spark, tmp_path):
    path = tmp_path / "coa.csv"
    path.write_text(COA)
    rows = files.read_account_list(spark, str(path)).collect()
    assert [(r["account_number"], r["full_name"]) for r in rows] == [
        ("1071", "Clearing"), ("6010", "Marketing:Ads"), ("Draws", "Equity:Owner")]
    assert rows[1]["description"] == "Ads, cards, and other"


def test_payout_report_offsets_become_instants(spark, tmp_path):
    from tillflow.operators.timing import payout_settlement

    path = tmp_path / "payouts.csv"
    path.write_text(PAYOUTS)
    lines = files.read_payout_report(spark, str(path))
    text = lines.selectExpr("CAST(transaction_time AS string) AS t").collect()
    assert text[0]["t"] == "2026-02-23 02:30:00"
    row = payout_settlement(lines).first()
    assert (row["charge_count"], row["gross_amount"], row["net_amount"]) == (2, 59.41, 57.5)
    assert (row["lag_days"], row["max_lag_days"]) == (1, 4)


def test_loan_configs_become_one_table(spark, tmp_path):
    for name, amort in (("a", "36"), ("b", "60  # five years")):
        (tmp_path / f"{name}.yaml").write_text(
            f'# note\nloan_id: "{name}"\nloan_name: "Loan # {name}"\nlender: "Bank"\n'
            f'annual_rate: 0.0725  # 7.25%\npayment_day: 15\nstart_date: "2024-01-15"\n'
            f'maturity_date: "2029-01-15"\ncurrent_balance: 1000.50\nio_months: 0\n'
            f'amort_months: {amort}\nfixed_payment: null\nballoon_amount: null\n')
    rows = sorted(files.read_loan_configs(spark, str(tmp_path)).collect(), key=lambda r: r["loan_id"])
    assert [(r["loan_id"], r["amort_months"]) for r in rows] == [("a", 36), ("b", 60)]
    assert rows[0]["loan_name"] == "Loan # a"
    assert (rows[0]["annual_rate"], rows[0]["current_balance"]) == (0.0725, 1000.5)
    assert rows[0]["fixed_payment"] is None
    assert rows[0]["start_date"] == dt.date(2024, 1, 15)


def test_category_map_from_config(spark):
    config = {"operating_inflows": [{"account": "Web", "account_number": "4001", "category": "R",
                                     "subcategory": "E", "cash_timing": "now"}],
              "non_cash_items": [{"account": "Depreciation"}],
              "clearing_accounts": [{"account": "Clearing"}]}
    rows = rules.category_map(spark, config).collect()
    assert [(r["account"], r["is_cash"]) for r in rows] == [
        ("Web", True), ("Depreciation", False), ("Clearing", False)]


def test_timing_rules_from_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "timing.yaml"
    path.write_text("""
revenue_timing:
  biweekly: {cycle: bi-weekly, settlement_period_days: 14, payout_lag_days: 2}
  daily: {cycle: daily, payout_lag_days: 2, payout_days: [Monday], weekend_handling: next_business_day}
  open: {cycle: TBD, payout_lag_days: null}
expense_timing:
  net_30: {payment_terms: Net 30, actual_payment_days: 32}
  card: {payment_delay_days: 30}
""")
    rows = {r["term_id"]: r for r in rules.timing_rules(spark, rules.load_yaml(path)).collect()}
    assert (rows["biweekly"]["settlement_period_days"], rows["biweekly"]["settlement_lag_days"]) == (14, 2)
    assert (rows["daily"]["lag_days"], rows["daily"]["weekend_handling"]) == (2, "Next Business Day")
    assert [rows[k]["lag_days"] for k in ("open", "net_30", "card")] == [None, 32, 30]


def test_seeds_pass_the_check(spark):
    house = Warehouse(spark, tables={"payment_terms": seeds.seed_payment_terms(spark),
                                     "scenarios": seeds.seed_scenarios(spark)})
    counts = {r["table_name"]: (r["row_count"], r["complete"]) for r in house.seed_check().collect()}
    assert counts == {"payment_terms": (7, True), "scenarios": (3, True)}
    assert seeds.seed_bank_accounts(spark).columns == TABLES["bank_accounts"].schema.fieldNames()
    first = seeds.seed_recurring(spark).orderBy("recurring_id").first()
    assert (first["currency"], first["recurrence_interval"], first["is_active"]) == ("USD", 1, True)


def test_catalog_check_names_what_is_missing(spark):
    have = {name: spark.createDataFrame([], layout.schema) for name, layout in TABLES.items()
            if name != "budget"}
    found = {r["table_name"]: r["found"] for r in Warehouse(spark, tables=have).catalog_check().collect()}
    assert len(found) == 16
    assert sorted(n for n, ok in found.items() if not ok) == [
        "budget", "v_cash_position", "v_daily_cash_flow", "v_weekly_cash_flow"]


def test_readers_filter_sort_and_describe(spark, tables):
    house = Warehouse(spark, tables={"deposits": tables.deposits, "vendors": tables.vendors})
    rows = house.deposits("1996-01-01", "1996-03-31", "Amazon")
    days = [r["date_time"] for r in rows.collect()]
    assert days == sorted(days) and {r["platform"] for r in rows.collect()} == {"Amazon"}
    assert min(days).year == max(days).year == 1996
    schema = {r["name"]: r["type"] for r in house.table_schema("vendors").collect()}
    assert schema == {"Name": "string", "Terms": "string", "Actual Days": "bigint",
                      "Request Days": "bigint"}
    assert house.is_reachable()


def test_sql_parameters_are_values_not_text(spark, tables):
    house = Warehouse(spark)
    found = house.sql("SELECT count(*) AS n FROM {v} WHERE Name = :name",
                      {"name": "x' OR '1' = '1"}, v=tables.vendors)
    assert found.first()["n"] == 0


def test_named_tables_come_from_the_catalog(spark):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("catalog_probe")
    house = Warehouse(spark)
    assert house.table_scan("catalog_probe", ["a"], "a > 0", ["a"], 1).collect() == [(1,)]
    assert "catalog_probe" in {r["table_name"] for r in house.list_tables().collect()}


def test_required_columns_are_required(spark):
    with pytest.raises(ValueError, match="transaction_id"):
        fill_missing(spark.createDataFrame([(1.0,)], "amount double"),
                     TABLES["cash_transactions"].schema)


def test_layouts_name_their_columns():
    for layout in TABLES.values():
        names = set(layout.schema.fieldNames())
        assert {c for c in (layout.date, layout.bucket, *layout.sort) if c} <= names
