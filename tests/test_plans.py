"""What the physical plans must and must not contain."""

import re

import pytest

from conftest import FOLDER
from test_oracle import NAMES
from tillflow.operators import etl, reports
from tillflow.plans import registry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(registry.load()[name].run(spark, FOLDER)) for name in NAMES}


def test_no_cross_joins_and_no_python(plans):
    for name, plan in plans.items():
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
            assert node not in plan, f"{name} has {node}"


def test_single_partition_only_above_aggregates(plans):
    """A single-task exchange may carry roll-ups, never source rows."""
    for name, plan in plans.items():
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[i:])
                reached = re.search(r"HashAggregate|SortAggregate|FileScan|Range", below)
                assert reached and reached.group() != "FileScan", f"{name}: rows in one task"


def scan_of(df, table):
    """Pushed filters and read schema of a table's scan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return next(part for part in text.split("\n\n")
                if ") Scan parquet" in part and f"/{table}.parquet" in part)


def test_range_and_columns_reach_the_scan(tables):
    scan = scan_of(reports.operating_inflows(tables.deposits, "1996-01-01", "1996-12-31"), "lineitem")
    pushed = re.search(r"PushedFilters: .*", scan).group()
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed
    assert "Not(EqualTo(l_returnflag,R))" in pushed
    read = re.search(r"ReadSchema: .*", scan).group()
    assert "l_shipdate" in read and "l_suppkey" not in read and "l_partkey" not in read


def test_reports_read_only_their_columns(tables):
    daily = etl.invoices_to_ledger(tables.invoices, tables.vendors).groupBy("cash_date").count()
    read = re.search(r"ReadSchema: .*", scan_of(daily, "lineitem")).group()
    assert "l_discount" not in read and "l_partkey" not in read


def test_settlement_is_spread_over_orders(tables):
    """A settlement with most of the rows is counted by order first."""
    plan = plan_of(etl.settle_deposits(tables.deposits))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("order_id" in k and "settlement_id" in k for k in keys)


@pytest.mark.parametrize("name", ["vendor_payments", "purchase_commitments", "invoices_preview"])
def test_dimension_joins_have_another_way(spark, name):
    """Without the size that allows a broadcast the join is a sort-merge join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(registry.load()[name].run(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["purchase_commitments", "consolidated_cash_flow"])
def test_vendors_meet_sums_per_day(spark, name):
    """A hot vendor reaches its join as one row a day, without any skew handling."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.forceOptimizeSkewedJoin": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plan = plan_of(registry.load()[name].run(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    join = plan.index("SortMergeJoin [vendor")
    assert re.search(r"HashAggregate\(keys=\[\w+date#\d+, vendor#\d+\]", plan[join:])


def test_invoice_totals_join_no_invoices_again(spark):
    plan = registry.load()["invoices_preview"].run(spark, FOLDER)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2  # invoices once, vendor sums once


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
