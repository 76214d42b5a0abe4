"""Stored tables: append, scenario swap, duplicate-free insert, loan removal."""

import pytest
from pyspark.sql import functions as F

from tillflow.operators import debt, forecast
from tillflow.schemas import TABLES
from tillflow.sources import sinks

AS_OF = "1998-07-01"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def facts(df):
    return sorted((r["transaction_id"], str(r["cash_date"]), r["amount"], r["scenario_id"])
                  for r in df.collect())


def test_append_and_read_back(spark, tables, path):
    sinks.append_ledger(tables.ledger, path)
    stored = sinks.read_ledger(spark, path)
    assert stored.columns == tables.ledger.columns
    assert facts(stored) == facts(tables.ledger)
    window = sinks.read_ledger(spark, path, "1996-02-10", "1996-03-05")
    assert facts(window) == facts(tables.ledger.where(
        "cash_date BETWEEN DATE '1996-02-10' AND DATE '1996-03-05'"))
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((slice" in plan


def test_replacing_a_scenario_twice_is_the_same_as_once(spark, tables, path):
    sinks.append_ledger(tables.ledger, path)
    others = facts(sinks.without_scenario(tables.ledger, "base"))
    new = tables.planned_ledger.where("scenario_id = 'base' AND amount > 100000")
    for _ in range(2):
        sinks.replace_scenario(new, path, "base")
        assert facts(sinks.read_ledger(spark, path)) == sorted(others + facts(new))
    sinks.replace_scenario(new.where("false"), path, "base")
    assert facts(sinks.read_ledger(spark, path)) == others


def test_a_forecast_may_read_the_ledger_it_is_written_to(spark, tables, path):
    sinks.append_ledger(tables.actual_ledger, path)
    lines = forecast.weekly_forecast(sinks.read_ledger(spark, path), tables.recurring_transactions,
                                     tables.debt_schedule(AS_OF), AS_OF, 4, ("base",))
    rows = forecast.forecast_to_ledger(lines)
    for _ in range(2):
        sinks.replace_scenario(rows, path, "base")
    stored = sinks.read_ledger(spark, path)
    assert stored.where("is_forecast").count() == lines.count()
    assert stored.where("NOT is_forecast").count() == tables.actual_ledger.count()


def test_repeated_insert_adds_nothing(spark, tables, path):
    rows = debt.as_debt_rows(tables.debt_schedule(AS_OF), ids="hash")
    sinks.write_table(rows.where("loan_id < 'loan-5'"), "debt_schedule", path)
    for _ in range(2):
        sinks.insert_ignoring_duplicates(rows, "debt_schedule", path, ["schedule_id"])
        stored = sinks.read_table(spark, "debt_schedule", path)
        assert stored.count() == rows.count() == stored.select("schedule_id").distinct().count()


def test_deleting_a_loan_leaves_the_others(spark, tables, path):
    rows = debt.as_debt_rows(tables.debt_schedule(AS_OF), ids="hash")
    sinks.write_table(rows, "debt_schedule", path)
    for loan in ("loan-7", "loan-7", "no such loan"):
        sinks.delete_loan(spark, path, loan)
    counts = dict(sinks.read_table(spark, "debt_schedule", path).groupBy("loan_id").count().collect())
    wanted = dict(rows.groupBy("loan_id").count().collect())
    assert wanted.pop("loan-7") > 0
    assert counts == wanted


def test_deleting_the_only_loan_of_a_bucket(spark, tables, path):
    rows = debt.as_debt_rows(tables.debt_schedule(AS_OF).where("loan_id = 'loan-7'"))
    sinks.write_table(rows, "debt_schedule", path)
    sinks.delete_loan(spark, path, "loan-7")
    assert sinks.read_table(spark, "debt_schedule", path).count() == 0


def test_undated_table_round_trip(spark, path):
    from tillflow.sources import seeds

    sinks.write_table(seeds.seed_scenarios(spark), "scenarios", path)
    assert sinks.read_table(spark, "scenarios", path).count() == 3


def test_whole_warehouse(spark, tables, path):
    from tillflow.sources import store
    from tillflow.sources.warehouse import Warehouse

    for _ in range(2):
        store.create_tables(spark, path)
        store.seed_tables(spark, path)
    sinks.append_ledger(tables.actual_ledger, f"{path}/cash_transactions")
    house = Warehouse(spark, tables=store.open_tables(spark, path, AS_OF))
    assert house.catalog_check().where("NOT found").count() == 0
    assert [r["row_count"] for r in house.seed_check().orderBy("table_name").collect()] == [7, 3]
    store.register_views(spark, path, AS_OF)
    try:
        total = spark.sql("SELECT sum(transaction_count) AS n FROM v_daily_cash_flow").first()["n"]
    finally:
        for name in house.tables:  # other tests look at the catalog
            spark.catalog.dropTempView(name)
    assert total == tables.actual_ledger.count()
    assert house.table("v_cash_position").first()["total_cash"] is None


@pytest.mark.parametrize("name", ["none", "best:v2", "50% a/b", "__HIVE_DEFAULT_PARTITION__"])
def test_scenarios_of_any_name(spark, tables, path, name):
    from pyspark.sql import functions as F

    plan = tables.planned_ledger.where("scenario_id = 'base'").limit(5).withColumn("scenario_id", F.lit(name))
    sinks.append_ledger(tables.actual_ledger.limit(7), path)
    sinks.replace_scenario(plan, path, name)
    stored = sinks.read_ledger(spark, path)
    assert stored.where(F.col("scenario_id") == name).count() == 5
    assert stored.where("scenario_id IS NULL").count() == 7
    sinks.replace_scenario(plan.where("false"), path, name)
    assert sinks.read_ledger(spark, path).count() == 7


def test_rows_without_a_cash_date_are_rejected(spark, tables, path):
    from pyspark.sql import functions as F

    rows = tables.actual_ledger.limit(3).withColumn("cash_date", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="without a cash date"):
        sinks.append_ledger(rows, path)


def test_a_corrected_settlement_replaces_the_old_amount(spark, tables, path):
    from pyspark.sql import functions as F

    old = tables.actual_ledger.where("source_system = 'deposits'").orderBy("transaction_id").limit(40)
    sinks.append_ledger(old, path)
    new = old.orderBy("transaction_id").limit(3).withColumn("amount", F.col("amount") + 50.0)
    sinks.upsert_ledger(new, path, ["source_system", "source_id", "transaction_id"])
    stored = sinks.read_ledger(spark, path)
    assert stored.count() == 40
    assert facts(stored.join(new.select("transaction_id"), "transaction_id", "left_semi")) == facts(new)


def test_tables_are_pruned_and_keep_their_columns(spark, tables, path):
    rows = debt.as_debt_rows(tables.debt_schedule(AS_OF), ids="hash")
    sinks.write_table(rows, "debt_schedule", path)
    one = sinks.read_table(spark, "debt_schedule", path, key="loan-7")
    assert "bucket" not in one.columns
    assert one.count() == rows.where("loan_id = 'loan-7'").count() > 0
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def amounts(spark, path):
    rows = sinks.read_ledger(spark, path).where("is_forecast")
    return {(r["scenario_id"], r["amount"]): r["n"] for r in
            rows.groupBy("scenario_id", "amount").agg(F.count(F.lit(1)).alias("n")).collect()}


def scenario_rows(frame, scenario, *values):
    return frame("transaction_id string, cash_date date, transaction_date date, cash_flow_section string, "
                 "cash_flow_category string, amount double, is_forecast boolean, scenario_id string, source_system string",
                 *[(f"{scenario}-{v}", "2026-03-01", "2026-03-01", "Operating", "A", v, True, scenario, "test") for v in values])


def test_a_replacement_that_dies_before_its_pointer_changes_nothing(spark, frame, path, monkeypatch):
    sinks.append_ledger(scenario_rows(frame, "base", 1.0, 2.0).unionByName(scenario_rows(frame, "best/1", 5.0)), path)
    before = sinks.read_ledger(spark, path)  # opened before, read after
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.replace_scenario(scenario_rows(frame, "base", 7.0), path, "base")
    assert amounts(spark, path) == {("base", 1.0): 1, ("base", 2.0): 1, ("best/1", 5.0): 1}
    sinks.replace_scenario(scenario_rows(frame, "base", 8.0), path, "base")
    sinks.replace_scenario(scenario_rows(frame, "best/1", 6.0), path, "best/1")
    assert amounts(spark, path) == {("base", 8.0): 1, ("best/1", 6.0): 1}
    assert before.where("is_forecast").agg(F.sum("amount")).first()[0] == 8.0  # the old 1 + 2 + 5
    sinks.append_ledger(scenario_rows(frame, "base", 9.0), path)
    assert amounts(spark, path) == {("base", 8.0): 1, ("base", 9.0): 1, ("best/1", 6.0): 1}
    assert sinks.drop_old_slices(spark, path) == 3  # the first two slices and the lost one
    assert amounts(spark, path) == {("base", 8.0): 1, ("base", 9.0): 1, ("best/1", 6.0): 1}
    sinks.replace_scenario(scenario_rows(frame, "base").limit(0), path, "base")
    assert amounts(spark, path) == {("best/1", 6.0): 1}


def test_an_unfinished_pointer_is_no_commit_and_a_second_writer_fails(spark, frame, path):
    sinks.append_ledger(scenario_rows(frame, "base", 1.0), path)
    sinks.replace_scenario(scenario_rows(frame, "base", 2.0), path, "base")
    target, system = sinks._file_system(spark, f"{path}/_pointers/{sinks._escaped(spark, 'of base')}/{2:012d}")
    stream = system.create(target, False)
    stream.write(bytearray(b"of base\nforecast-x"))
    stream.close()
    assert amounts(spark, path) == {("base", 2.0): 1}
    with pytest.raises(Exception, match="exist"):
        sinks._commit_pointer(spark, path, "of base", 1, "forecast-y")


def test_keys_are_found_in_other_months_and_the_first_row_stays(spark, frame, path):
    name, key = "gl_transactions", [TABLES["gl_transactions"].schema.fieldNames()[0]]
    day = TABLES[name].date
    made = lambda *rows: frame(f"{key[0]} string, {day} date, account_name string, amount double", *rows)
    sinks.write_table(made(("a", "2026-01-05", "x", 1.0)), name, path)
    batch = made(("a", "2026-02-07", "x", 9.0), ("b", "2026-02-01", "x", 2.0), ("b", "2026-03-01", "x", 3.0),
                 (None, "2026-03-01", "x", 4.0), (None, "2026-04-01", "x", 5.0)).coalesce(1)
    for _ in range(2):
        sinks.insert_ignoring_duplicates(batch, name, path, key)
        stored = sinks.read_table(spark, name, path)
        assert sorted((str(r[key[0]]), str(r[day]), r["amount"]) for r in stored.collect()) == [
            ("None", "2026-03-01", 4.0), ("a", "2026-01-05", 1.0), ("b", "2026-02-01", 2.0)]
    sinks.write_table(made(("c", "2026-05-05", "x", 6.0)), name, path)  # past the index
    sinks.insert_ignoring_duplicates(made(("c", "2026-06-05", "x", 7.0), ("d", "2026-06-05", "x", 8.0)), name, path, key)
    assert sorted(r["amount"] for r in sinks.read_table(spark, name, path).collect()) == [1.0, 2.0, 4.0, 6.0, 8.0]


def test_an_insert_that_dies_before_the_index_is_not_repeated(spark, frame, path, monkeypatch):
    name, day = "gl_transactions", TABLES["gl_transactions"].date
    key = [TABLES[name].schema.fieldNames()[0]]
    made = lambda *rows: frame(f"{key[0]} string, {day} date, account_name string, amount double", *rows)
    sinks.write_table(made(("a", "2026-01-05", "x", 1.0)), name, path)
    real = sinks._write_keys
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_write_keys", lambda rows, folder, key, mode: real(rows, folder, key, mode)
                      if mode == "overwrite" else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.insert_ignoring_duplicates(made(("b", "2026-02-05", "x", 2.0)), name, path, key)
    sinks.insert_ignoring_duplicates(made(("b", "2026-03-05", "x", 3.0), ("c", "2026-03-05", "x", 4.0)), name, path, key)
    assert sorted(r["amount"] for r in sinks.read_table(spark, name, path).collect()) == [1.0, 2.0, 4.0]


def test_rows_without_a_loan_survive_a_deletion(frame):
    rows = frame("loan_id string, n int", ("loan-7", 1), (None, 2), ("loan-8", 3))
    assert sorted(r["n"] for r in sinks.without_loan(rows, "loan-7").collect()) == [2, 3]
