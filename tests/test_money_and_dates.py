from pyspark.sql import functions as F

from tillflow.functions import dates, money


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_sum_is_exact_where_doubles_are_not(frame):
    df = frame("a double", *[(0.1,)] * 10, (None,)).coalesce(1)
    assert df.agg(money.money_sum("a").alias("s")).first()["s"] == 1.0
    assert df.agg(F.sum("a").alias("s")).first()["s"] != 1.0


def test_sum_of_nulls_is_null(frame):
    assert frame("a double", (None,)).agg(money.money_sum("a").alias("s")).first()["s"] is None


def test_in_and_out_are_zero_without_matches(frame):
    row = frame("a double", (-2.5,), (0.0,)).agg(
        money.inflow_sum("a").alias("i"), money.outflow_sum("a").alias("o")).first()
    assert (row["i"], row["o"]) == (0.0, 2.5)


def test_cents_round_half_away_from_zero(spark):
    for given, wanted in [(0.125, 0.13), (-0.125, -0.13), (2.0, 2.0), (-0.001, 0.0)]:
        assert value(spark, money.cents(F.lit(given))) == wanted


def test_large_money_prints_plainly(spark):
    assert value(spark, money.money_text(F.lit(12345678.9))) == "12345678.90"


def test_weeks_start_on_monday(spark):
    assert str(value(spark, dates.week_start(F.lit("2024-03-03").cast("date")))) == "2024-02-26"


def test_weekend_rolls(spark):
    saturday = F.lit("2024-03-02").cast("date")
    assert str(value(spark, dates.next_weekday(saturday))) == "2024-03-04"
    assert str(value(spark, dates.previous_weekday(saturday))) == "2024-03-01"
