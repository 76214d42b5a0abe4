"""Dashboard metrics over the ledger and the cash position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import DateLike, week_start, weeks_before
from tillflow.functions.money import from_units, inflow_sum, money_sum, outflow_sum, units

# Cash-buffer limits and the runway that raises a flag.
MINIMUM_CASH = 50_000.0
TARGET_CASH = 100_000.0
SHORT_RUNWAY_WEEKS = 4


def scenario_ledger(ledger: DataFrame, as_of: DateLike, scenario: str = "base",
                    lookback_weeks: int = 13) -> DataFrame:
    """Actuals plus one scenario's forecast rows since the lookback."""
    wanted = ~F.col("is_forecast") | (F.col("scenario_id") == scenario)
    return (ledger.where((F.col("cash_date") >= weeks_before(as_of, lookback_weeks)) & wanted)
            .select("cash_date", "cash_flow_section", "cash_flow_category", "amount",
                    "is_forecast", "scenario_id", "description"))


def weekly_in_out(ledger: DataFrame, as_of: DateLike, scenario: str = "base",
                  lookback_weeks: int = 13) -> DataFrame:
    rows = scenario_ledger(ledger, as_of, scenario, lookback_weeks)
    return (rows.groupBy(week_start(F.col("cash_date")).alias("week_start"))
            .agg(money_sum("amount").alias("net_cash_flow"),
                 inflow_sum("amount").alias("inflows"), outflow_sum("amount").alias("outflows"))
            .select("week_start", F.date_add("week_start", 6).alias("week_end"),
                    "net_cash_flow", "inflows", "outflows"))


def starting_balance(position: DataFrame, override: str | float | None = None) -> Column:
    """The override when it reads as a number, else the current liquidity."""
    liquidity = position.select("total_liquidity").scalar()
    return F.coalesce(F.lit(None if override is None else str(override)).try_cast("double"),
                      liquidity)


def weekly_balance(weekly: DataFrame, position: DataFrame,
                   override: str | float | None = None) -> DataFrame:
    """Weeks with their running balance, numbered from 1.

    Input rows are weeks already, so the one window partition stays small.
    """
    order = Window.orderBy("week_start")
    running = F.sum(units("net_cash_flow")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (weekly
            .withColumn("cash_balance",
                        from_units(units(starting_balance(position, override)) + running))
            .withColumn("week_index", F.row_number().over(order)))


def _summary(balances: DataFrame) -> DataFrame:
    """One row of everything the metrics below need from the weekly balances."""
    negative = F.col("cash_balance") < 0
    return balances.agg(
        F.min(F.when(negative, F.col("week_index"))).alias("runway_weeks"),
        F.sum(units("net_cash_flow")).alias("total_net"),
        F.count("net_cash_flow").alias("weeks"),
        F.max_by("cash_balance", "week_start").alias("last_balance"),
        F.coalesce(F.bool_or(negative), F.lit(False)).alias("any_negative"))


def runway(balances: DataFrame) -> DataFrame:
    """Number of the first week below zero, NULL when there is none."""
    return _summary(balances).select("runway_weeks")


def _burn() -> Column:
    net = from_units(F.col("total_net"))
    return F.when(F.coalesce(F.col("total_net"), F.lit(0)) >= 0, 0.0) \
            .otherwise(F.abs(net / F.col("weeks")))


def burn_rate(balances: DataFrame) -> DataFrame:
    """Mean weekly loss; 0 when the weeks together do not lose cash."""
    return _summary(balances).select(_burn().alias("burn_rate"))


def risk_flags(balances: DataFrame) -> DataFrame:
    """One row per warning, or the single row that there is none.

    Fixed values: the warning texts.
    """
    weeks = F.col("runway_weeks")
    flags = F.filter(F.array(
        F.when(weeks < SHORT_RUNWAY_WEEKS,
               F.concat(F.lit("Runway under 4 weeks ("), weeks.cast("string"), F.lit(" weeks)"))),
        F.when(weeks.isNull() & F.col("any_negative"),
               F.lit("One or more weeks show negative cash balance")),
        F.when(F.col("last_balance") < 0, F.lit("Ending cash balance is negative"))),
        lambda flag: flag.isNotNull())
    none = F.array(F.lit("No high-priority risk flags"))
    return _summary(balances).select(
        F.explode(F.when(F.size(flags) > 0, flags).otherwise(none)).alias("risk_flag"))


def dashboard_kpis(balances: DataFrame, position: DataFrame,
                   override: str | float | None = None) -> DataFrame:
    return _summary(balances).select(
        starting_balance(position, override).alias("cash_position"), "runway_weeks",
        _burn().alias("burn_rate"))


def scenario_comparison(ledger: DataFrame, as_of: DateLike, starting: float = 0.0,
                        lookback_weeks: int = 13) -> DataFrame:
    """Weekly net and running balance per scenario; actuals are scenario NULL."""
    net = (ledger.where(F.col("cash_date") >= weeks_before(as_of, lookback_weeks))
           .groupBy(week_start(F.col("cash_date")).alias("week_start"), "scenario_id")
           .agg(money_sum("amount").alias("net_cash_flow")))
    running = F.sum(units("net_cash_flow")).over(
        Window.partitionBy("scenario_id").orderBy("week_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return net.withColumn("cash_balance", from_units(units(F.lit(float(starting))) + running))


def scenario_table(comparison: DataFrame, scenarios: list[str]) -> DataFrame:
    """Weekly balances with one column per scenario, and ``actual``."""
    named = comparison.withColumn("scenario_id", F.coalesce("scenario_id", F.lit("actual")))
    return (named.groupBy("week_start").pivot("scenario_id", ["actual", *scenarios])
            .agg(F.first("cash_balance")))


def weekly_measures(weekly_view: DataFrame, dimensions: list[str]) -> DataFrame:
    """Net flow and transaction count of the weekly view by any dimensions."""
    return (weekly_view.groupBy(*dimensions)
            .agg(money_sum("net_cash_flow").alias("total_net_cash_flow"),
                 F.sum("transaction_count").alias("total_transaction_count")))


def weekly_row_key(weekly_view: DataFrame) -> DataFrame:
    """The weekly view with its unique row key."""
    blank = F.lit("")
    return weekly_view.withColumn("row_key", F.concat_ws(
        "_", F.col("week_start").cast("string"), F.coalesce("cash_flow_section", blank),
        F.coalesce("cash_flow_category", blank)))


def position_measures(position: DataFrame) -> DataFrame:
    return position.agg(money_sum("total_cash").alias("total_cash"),
                        money_sum("total_liquidity").alias("total_liquidity"),
                        money_sum("total_loc_available").alias("total_loc_available"))


def cash_buffer_flags(balances: DataFrame, minimum: float = MINIMUM_CASH,
                      target: float = TARGET_CASH) -> DataFrame:
    """Each week's standing against the minimum and the target balance."""
    cash = F.col("cash_balance")
    return balances.withColumn("buffer_status", F.when(cash < minimum, "below_minimum")
                               .when(cash < target, "below_target").otherwise("on_target"))
