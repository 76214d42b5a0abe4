"""Rolling weekly forecast from actuals, recurring items and debt.

Weeks run from ``as_of``: week k starts 7(k-1) days later.  One-row inputs
(the expense average) are exploded into weeks and scenarios, so a forecast of
all scenarios is one plan without cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.classify import financing_if_debt
from tillflow.functions.dates import DateLike, date_lit, month_start, weeks_before
from tillflow.functions.money import from_units, units
from tillflow.operators.etl import DEFAULT_ACCOUNT, as_ledger
from tillflow.operators.timing import seasonal_factor

# Fixed values: (revenue factor, expense factor) by scenario.
FACTORS = {"base": (1.0, 1.0), "best": (1.15, 0.90), "worst": (0.85, 1.10)}

LINE_COLUMNS = ["week_number", "week_start", "week_end", "transaction_date",
                "cash_flow_section", "cash_flow_category", "description", "amount", "scenario"]


# ---- inputs -----------------------------------------------------------------

def historical_actuals(ledger: DataFrame, as_of: DateLike, lookback_weeks: int = 12) -> DataFrame:
    """Actual rows since ``lookback_weeks`` before ``as_of``; no upper end."""
    return (ledger.where(~F.col("is_forecast")
                         & (F.col("cash_date") >= weeks_before(as_of, lookback_weeks)))
            .select("cash_date", "cash_flow_section", "cash_flow_category",
                    "counterparty", "amount"))


def _by_category(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("cash_flow_category")
            .agg(F.sum(units("amount")).alias("whole"),
                 F.min("cash_date").alias("first_day"), F.max("cash_date").alias("last_day")))


def _weeks_in_range() -> Column:
    days = F.datediff(F.max("last_day"), F.min("first_day"))
    return F.greatest(days / 7.0, F.lit(1.0))


def _weekly_summary(rows: DataFrame, total_name: str) -> DataFrame:
    """One row: total, weeks covered (at least 1), average per week; 0 when empty."""
    total = from_units(F.abs(F.coalesce(F.sum("whole"), F.lit(0))))
    return (_by_category(rows)
            .agg(total.alias(total_name), _weeks_in_range().alias("weeks_in_range"))
            .withColumn("weekly_avg", F.coalesce(F.col(total_name) / F.col("weeks_in_range"),
                                                 F.lit(0.0)))
            .withColumn("weekly_std", F.lit(0.0)))


def revenue_trend(actuals: DataFrame) -> DataFrame:
    return _weekly_summary(actuals.where("amount > 0"), "total_revenue")


def revenue_split(actuals: DataFrame) -> DataFrame:
    """Share of each revenue category in percent."""
    by_category = _by_category(actuals.where("amount > 0"))
    total = by_category.agg(F.sum("whole")).scalar()
    return by_category.select("cash_flow_category", from_units(F.col("whole")).alias("revenue"),
                              (F.try_divide(F.col("whole"), total) * 100).alias("share_pct"))


def expense_pattern(actuals: DataFrame) -> DataFrame:
    return _weekly_summary(actuals.where("amount < 0"), "total_expenses")


def expense_by_category(actuals: DataFrame) -> DataFrame:
    return (_by_category(actuals.where("amount < 0"))
            .select("cash_flow_category", from_units(F.col("whole")).alias("total_amount")))


def active_recurring(recurring: DataFrame, as_of: DateLike) -> DataFrame:
    today = date_lit(as_of)
    live = (F.col("is_active") & (F.col("start_date") <= today)
            & (F.col("end_date").isNull() | (F.col("end_date") >= today)))
    optional = [c for c in ("day_of_week", "month_of_year") if c in recurring.columns]
    return (recurring.where(live)
            .select("recurring_id", F.col("transaction_name").alias("description"), "amount",
                    "cash_flow_category", "frequency", "recurrence_interval", "day_of_month",
                    "start_date", "end_date", *optional))


def upcoming_debt(schedule: DataFrame, as_of: DateLike, weeks: int = 13) -> DataFrame:
    """Unpaid payments from ``as_of`` to ``weeks`` later, both days included."""
    day = F.col("payment_date")
    return (schedule.where((day >= date_lit(as_of))
                           & (day <= F.date_add(date_lit(as_of), 7 * weeks)) & ~F.col("is_paid"))
            .select("payment_date", "loan_name", "lender", "payment_amount",
                    "principal_amount", "interest_amount"))


# ---- calendar and scenarios -------------------------------------------------

def _week_range(weeks: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(weeks)))


def with_week_span(rows: DataFrame, as_of: DateLike) -> DataFrame:
    """``week_start`` and ``week_end`` of ``week_number``."""
    start = F.date_add(date_lit(as_of), 7 * (F.col("week_number") - 1))
    return rows.withColumn("week_start", start).withColumn("week_end", F.date_add(start, 6))


def forecast_weeks(rows: DataFrame, as_of: DateLike, weeks: int = 13) -> DataFrame:
    """Every input row once per forecast week."""
    return with_week_span(rows.withColumn("week_number", _week_range(weeks)), as_of)


def _factor(scenario: Column, which: int) -> Column:
    """The scenario's factor; unknown scenarios use the base factor."""
    out = None
    for name, factors in FACTORS.items():
        value = F.lit(factors[which])
        out = F.when(scenario == name, value) if out is None else out.when(scenario == name, value)
    return out.otherwise(F.lit(FACTORS["base"][which]))


def stored_factors(scenarios: DataFrame) -> DataFrame:
    """(scenario, revenue_factor, expense_factor) of the active rows of the scenarios table.

    A growth or inflation rate r is the factor 1 + r; ``custom_assumptions`` may name
    revenue_factor and expense_factor outright, as JSON.  What a row leaves open is NULL.
    """
    live = F.coalesce("is_active", F.lit(True)) if "is_active" in scenarios.columns else F.lit(True)

    def factor(name: str, rate: str) -> Column:
        by_rate = 1.0 + F.col(rate) if rate in scenarios.columns else F.lit(None).cast("double")
        if "custom_assumptions" not in scenarios.columns:
            return by_rate
        return F.coalesce(F.get_json_object("custom_assumptions", f"$.{name}").try_cast("double"), by_rate)

    return (scenarios.where(live)
            .groupBy(F.col("scenario_id").alias("scenario"))
            .agg(F.max(factor("revenue_factor", "revenue_growth_rate")).alias("revenue_factor"),
                 F.max(factor("expense_factor", "expense_inflation_rate")).alias("expense_factor")))


def scenario_factors(requests: DataFrame, scenario: str = "scenario",
                     stored: DataFrame | None = None) -> DataFrame:
    """Revenue and expense factor for each row's scenario name.

    ``stored`` is the scenarios table: its factors count where it has the scenario and
    the rate, else the default of that name, else that of base.  The table meets the rows as a
    dimension, one row a scenario, so nothing fans out.
    """
    name = F.col(scenario)
    defaults = [_factor(name, 0), _factor(name, 1)]
    if stored is None:
        return requests.withColumn("revenue_factor", defaults[0]).withColumn("expense_factor", defaults[1])
    known = stored_factors(stored).select(F.col("scenario").alias("_scenario"),
                                          F.col("revenue_factor").alias("_revenue"),
                                          F.col("expense_factor").alias("_expense"))
    return (requests.join(known, name == F.col("_scenario"), "left")
            .withColumn("revenue_factor", F.coalesce("_revenue", defaults[0]))
            .withColumn("expense_factor", F.coalesce("_expense", defaults[1]))
            .drop("_scenario", "_revenue", "_expense"))


def per_scenario(rows: DataFrame, scenarios: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Every input row once per scenario, with its factors."""
    names = F.array(*[F.lit(s) for s in scenarios])
    return scenario_factors(rows.withColumn("scenario", F.explode(names)), stored=stored)


# ---- lines ------------------------------------------------------------------

def _lines(rows: DataFrame) -> DataFrame:
    return rows.select(*LINE_COLUMNS)


def _week_text(what: str) -> Column:
    return F.concat(F.lit("Week "), F.col("week_number").cast("string"), F.lit(f" - {what}"))


def _season_of_week(week_start: Column) -> Column:
    """Mean seasonal factor of the week's seven days; a week across a month end has both."""
    days = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: seasonal_factor(F.date_add(week_start, k)))
    return F.aggregate(days, F.lit(0.0), lambda total, factor: total + factor) / 7


def seasonal_baseline(ledger: DataFrame, as_of: DateLike, months: int = 3) -> DataFrame:
    """One row: the weekly revenue of a month with factor 1, from the trailing ``months``.

    The revenue of the actual rows from ``months`` before ``as_of`` up to the day before, over
    the factors of those days: a peak month's sales do not raise the base of a quiet one.
    """
    end = date_lit(as_of)
    begin = F.add_months(end, -months)
    rows = ledger.where(~F.col("is_forecast") & (F.col("amount") > 0)
                        & (F.col("cash_date") >= begin) & (F.col("cash_date") < end))
    days = F.transform(F.sequence(begin, F.date_sub(end, 1)), seasonal_factor)
    weight = F.aggregate(days, F.lit(0.0), lambda total, factor: total + factor)
    revenue = from_units(F.coalesce(F.sum(units("amount")), F.lit(0)))
    return rows.agg(revenue.alias("revenue")).select((F.col("revenue") / weight * 7).alias("weekly_revenue"))


def forecast_revenue_lines(weekly_revenue: DataFrame, as_of: DateLike, weeks: int = 13,
                           scenarios: Sequence[str] = ("base",), seasonal: bool = False,
                           stored: DataFrame | None = None) -> DataFrame:
    """Revenue at the end of each week for each positive ``weekly_revenue`` row.

    ``seasonal`` splits a week's revenue evenly over its days and scales each by the factor
    of its month.  ``stored`` is the scenarios table, see ``scenario_factors``.
    """
    rows = per_scenario(forecast_weeks(weekly_revenue.where("weekly_revenue > 0"), as_of, weeks),
                        scenarios, stored)
    base = F.col("weekly_revenue") * _season_of_week(F.col("week_start")) if seasonal else F.col("weekly_revenue")
    return _lines(rows.select(
        "*", F.col("week_end").alias("transaction_date"),
        F.lit("Operating").alias("cash_flow_section"),
        F.lit("Revenue - Ecommerce").alias("cash_flow_category"),
        _week_text("Revenue (forecast)").alias("description"),
        (base * F.col("revenue_factor")).alias("amount")))


def forecast_opex_lines(pattern: DataFrame, as_of: DateLike, weeks: int = 13,
                        scenarios: Sequence[str] = ("base",), stored: DataFrame | None = None,
                        inflation: float = 0.0) -> DataFrame:
    """The average weekly expense as an outflow at the end of each week.

    ``inflation`` is a yearly rate; a week's expense grows with its end's share of a year.
    """
    rows = per_scenario(forecast_weeks(pattern.select("weekly_avg"), as_of, weeks), scenarios, stored)
    amount = F.col("weekly_avg") * F.col("expense_factor")
    if inflation:
        amount = amount * F.pow(F.lit(1.0 + inflation), F.datediff("week_end", date_lit(as_of)) / 365.0)
    return _lines(rows.select(
        "*", F.col("week_end").alias("transaction_date"),
        F.lit("Operating").alias("cash_flow_section"),
        F.lit("Operating Expenses").alias("cash_flow_category"),
        _week_text("OpEx (forecast)").alias("description"),
        (0.0 - amount).alias("amount")))


def _optional(frame: DataFrame, name: str) -> Column:
    return (F.col(name) if name in frame.columns else F.lit(None)).cast("int")


def occurrences(items: DataFrame, as_of: DateLike, weeks: int) -> DataFrame:
    """``items`` once per ``transaction_date`` that falls in the ``weeks`` from ``as_of``.

    Daily and Weekly items step by days from their start, Weekly ones from the first
    ``day_of_week`` (1 is Monday) on or after it.  Quarterly and Annually step by months from the
    start's month (Annually from the first ``month_of_year``), on ``day_of_month`` or the
    start's day; a day beyond the month's end is its last day.  All step by
    ``recurrence_interval`` and end with ``end_date``.

    Monthly, also for an unknown or missing frequency, keeps the simple rule: each month that
    has the ``day_of_month``, a month without it has no payment; an end date inside the
    span does not cut it.  With an interval above 1 only every n-th month from the start counts.

    The first step inside the span follows by division, so an item expands to its own
    dates only: a narrow operation.
    """
    first, start = date_lit(as_of), F.col("start_date")
    last = F.date_add(first, 7 * weeks - 1)
    kind = F.col("frequency")
    every = F.greatest(F.coalesce(F.col("recurrence_interval").cast("int"), F.lit(1)), F.lit(1))
    month_of = lambda day: F.year(day) * 12 + F.month(day) - 1

    def steps(low: Column, high: Column) -> Column:
        return F.when(low <= high, F.sequence(low, high))

    # by days
    week_day = _optional(items, "day_of_week")
    shift = F.when(kind == "Weekly", F.coalesce(F.pmod(week_day - 1 - F.weekday(start), F.lit(7)), F.lit(0))).otherwise(0)
    anchor, length = F.date_add(start, shift), F.when(kind == "Weekly", every * 7).otherwise(every)
    low = F.greatest(F.ceil(F.datediff(first, anchor) / length), F.lit(0)).cast("int")
    high = F.floor(F.datediff(F.least(last, F.coalesce("end_date", last)), anchor) / length).cast("int")
    by_days = F.transform(steps(low, high), lambda k: F.date_add(anchor, k * length))

    # by months, counted from the year 0
    year_month = _optional(items, "month_of_year")
    later = F.when(kind == "Annually", F.coalesce(F.pmod(year_month - F.month(start), F.lit(12)), F.lit(0))).otherwise(0)
    simple = ~F.coalesce(kind.isin("Quarterly", "Annually"), F.lit(False))
    begin = F.when(simple & (every == 1), month_of(first)).otherwise(month_of(start) + later)
    period = F.when(kind == "Quarterly", every * 3).when(kind == "Annually", every * 12).otherwise(every)
    low = F.greatest(F.ceil((month_of(first) - begin) / period), F.lit(0)).cast("int")
    high = F.floor((month_of(last) - begin) / period).cast("int")
    day = F.col("day_of_month").cast("int")

    def in_month(k: Column) -> Column:
        opening = F.add_months(F.lit("0001-01-01").cast("date"), begin + k * period - 12)
        length_of_month = F.dayofmonth(F.last_day(opening))
        clamped = F.date_add(opening, F.least(F.coalesce(day, F.dayofmonth(start)), length_of_month) - 1)
        plain = F.when(day <= length_of_month, F.date_add(opening, day - 1))
        inside = (clamped >= start) & (clamped <= F.coalesce("end_date", clamped))
        return F.when(simple, plain).when(inside, clamped)

    by_months = F.transform(steps(low, high), in_month)
    dates = F.when(kind.isin("Daily", "Weekly"), by_days).otherwise(by_months)
    return (items.withColumn("transaction_date", F.explode(dates))
            .where((F.col("transaction_date") >= first) & (F.col("transaction_date") <= last)))


def forecast_recurring_lines(active: DataFrame, as_of: DateLike, weeks: int = 13,
                             scenarios: Sequence[str] = ("base",), stored: DataFrame | None = None,
                             by_frequency: bool = False) -> DataFrame:
    """Each active item on its dates within the forecast span, see ``occurrences``.

    Without ``by_frequency`` every item counts as monthly, whatever its frequency and
    interval say: the plain forecast's rule.
    """
    if not by_frequency:
        active = active.withColumns({"frequency": F.lit("Monthly"), "recurrence_interval": F.lit(1)})
    dated = occurrences(active, as_of, weeks).withColumn("week_number", _week_of(as_of))
    rows = per_scenario(with_week_span(dated, as_of), scenarios, stored)
    return _lines(rows.select(
        *[c for c in rows.columns if c != "description"],
        financing_if_debt(F.col("cash_flow_category")).alias("cash_flow_section"),
        F.concat(F.col("description"), F.lit(" (recurring)")).alias("description")))


def _week_of(as_of: DateLike, day: str = "transaction_date") -> Column:
    return (F.floor(F.datediff(F.col(day), date_lit(as_of)) / 7) + 1).cast("int")


def forecast_debt_lines(debt: DataFrame, as_of: DateLike, weeks: int = 13,
                        scenarios: Sequence[str] = ("base",), stored: DataFrame | None = None) -> DataFrame:
    """Debt payments as outflows in weeks 1..``weeks``.

    The input window includes the day ``weeks`` later, which is week
    ``weeks + 1`` and drops out here.
    """
    numbered = (debt.withColumn("week_number", _week_of(as_of, "payment_date"))
                .where(F.col("week_number").between(1, weeks)))
    rows = per_scenario(with_week_span(numbered, as_of), scenarios, stored)
    return _lines(rows.select(
        "*", F.col("payment_date").alias("transaction_date"),
        F.lit("Financing").alias("cash_flow_section"),
        F.lit("Debt Service").alias("cash_flow_category"),
        F.concat(F.col("loan_name"), F.lit(" - "), F.col("lender")).alias("description"),
        (0.0 - F.col("payment_amount")).alias("amount")))


def weekly_forecast(ledger: DataFrame, recurring: DataFrame, debt: DataFrame, as_of: DateLike,
                    weeks: int = 13, scenarios: Sequence[str] = ("base",),
                    weekly_revenue: float | DataFrame = 0.0, lookback_weeks: int = 12,
                    stored_scenarios: DataFrame | None = None, seasonal: bool = False,
                    inflation: float = 0.0, by_frequency: bool = False) -> DataFrame:
    """All forecast lines of all requested scenarios.

    A loan that is both a recurring item and in the schedule counts twice.
    ``weekly_revenue`` is a number or a one-row table such as ``seasonal_baseline``;
    ``stored_scenarios`` is the scenarios table, whose factors come before the defaults;
    ``by_frequency`` lets recurring items follow their own frequency.
    """
    pattern = expense_pattern(historical_actuals(ledger, as_of, lookback_weeks))
    span, stored = (as_of, weeks, scenarios), stored_scenarios
    lines = (forecast_opex_lines(pattern, *span, stored, inflation)
             .unionByName(forecast_recurring_lines(active_recurring(recurring, as_of), *span, stored, by_frequency))
             .unionByName(forecast_debt_lines(upcoming_debt(debt, as_of, weeks), *span, stored)))
    if isinstance(weekly_revenue, DataFrame):
        planned = weekly_revenue.select("weekly_revenue")
    elif weekly_revenue > 0:
        planned = ledger.sparkSession.range(1).select(F.lit(weekly_revenue).alias("weekly_revenue"))
    else:
        return lines
    return lines.unionByName(forecast_revenue_lines(planned, *span, seasonal, stored))


# ---- position ---------------------------------------------------------------

def weekly_position(lines: DataFrame, starting_balance: float) -> DataFrame:
    """Net flow and running balance per scenario and week.

    The window runs per scenario over rows already rolled up to weeks.
    """
    net = (lines.groupBy("scenario", "week_number", "week_start", "week_end")
           .agg(F.sum(units("amount")).alias("whole")))
    running = F.sum("whole").over(Window.partitionBy("scenario").orderBy("week_number")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return net.select("scenario", "week_number", "week_start", "week_end",
                      from_units(F.col("whole")).alias("net_cash_flow"),
                      from_units(units(F.lit(float(starting_balance))) + running)
                      .alias("cash_balance"))


def runway_by_scenario(position: DataFrame) -> DataFrame:
    """First week with a negative balance, NULL when there is none."""
    return (position.groupBy("scenario")
            .agg(F.min(F.when(F.col("cash_balance") < 0, F.col("week_number")))
                 .alias("runway_weeks")))


def cash_position_runway(lines: DataFrame, starting_balance: float) -> DataFrame:
    """Weekly position with the scenario's runway on every row."""
    position = weekly_position(lines, starting_balance)
    whole = Window.partitionBy("scenario")
    runway = F.min(F.when(F.col("cash_balance") < 0, F.col("week_number"))).over(whole)
    return position.withColumn("runway_weeks", runway)


def forecast_to_ledger(lines: DataFrame, ids: str = "uuid",
                       account: tuple[str, str] = DEFAULT_ACCOUNT) -> DataFrame:
    """Forecast lines as ledger rows flagged as forecast."""
    day = F.col("transaction_date")
    key = F.concat_ws("|", "scenario", day.cast("string"), "cash_flow_category", "description",
                      units("amount").cast("string"))
    return as_ledger(lines.select(
        (F.uuid() if ids == "uuid" else F.sha2(key, 256)).alias("transaction_id"),
        day.alias("transaction_date"), day.alias("cash_date"), day.alias("value_date"),
        F.lit("forecast").alias("source_system"), F.lit("forecast_engine").alias("source_table"),
        F.lit(account[0]).alias("bank_account_id"), F.lit(account[1]).alias("bank_account_name"),
        "cash_flow_section", "cash_flow_category", "amount", "description",
        F.lit(True).alias("is_forecast"), F.col("scenario").alias("scenario_id"),
        F.lit("forecast_engine").alias("created_by")))


def cash_forecast_rollup(lines: DataFrame, starting_cash: float, as_of: DateLike,
                         loc_balance: float = 0.0, loc_available: float = 0.0,
                         forecast_id: str | None = None) -> DataFrame:
    """Forecast lines as one row per scenario and week with section columns.

    Inflows and outflows are magnitudes; burn is the mean weekly net when the
    scenario loses cash, else 0; runway is the first week below zero.
    """
    section, amount = F.col("cash_flow_section"), F.col("amount")

    def part(name: str, inflow: bool) -> Column:
        sign = (amount > 0) if inflow else (amount < 0)
        return F.sum(F.when((section == name) & sign, units(F.abs(amount)))
                     .otherwise(F.lit(0).cast("bigint")))

    weekly = (lines.groupBy("scenario", "week_number", "week_end")
              .agg(part("Operating", True).alias("op_in"), part("Operating", False).alias("op_out"),
                   part("Investing", False).alias("inv_out"),
                   part("Financing", True).alias("fin_in"),
                   part("Financing", False).alias("fin_out"),
                   F.sum(units("amount")).alias("net")))
    whole = Window.partitionBy("scenario")
    so_far = whole.orderBy("week_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = units(F.lit(float(starting_cash)))
    balanced = (weekly.withColumn("ending", start + F.sum("net").over(so_far))
                .withColumn("total_net", F.sum("net").over(whole))
                .withColumn("weeks", F.count(F.lit(1)).over(whole))
                .withColumn("runway", F.min(F.when(F.col("ending") < 0, F.col("week_number")))
                            .over(whole)))
    money = lambda name: from_units(F.col(name))
    burn = F.when(F.col("total_net") >= 0, 0.0).otherwise(
        F.abs(money("total_net")) / F.col("weeks"))
    return balanced.select(
        F.lit(forecast_id or f"forecast-{as_of}").alias("forecast_id"),
        date_lit(as_of).alias("forecast_date"),
        F.col("week_end").alias("period_date"), F.col("scenario").alias("scenario_id"),
        F.col("week_number").cast("bigint").alias("week_number"),
        F.lit(False).alias("is_actual"),
        money("op_in").alias("operating_inflows"), money("op_out").alias("operating_outflows"),
        from_units(F.col("op_in") - F.col("op_out")).alias("operating_cash_flow"),
        money("inv_out").alias("investing_outflows"),
        money("fin_in").alias("financing_inflows"), money("fin_out").alias("financing_outflows"),
        money("net").alias("net_cash_flow"),
        from_units(F.col("ending") - F.col("net")).alias("beginning_cash"),
        money("ending").alias("ending_cash"),
        F.lit(float(loc_balance)).alias("loc_balance"),
        F.lit(float(loc_available)).alias("loc_available"),
        from_units(F.col("ending") + units(F.lit(float(loc_available)))).alias("total_liquidity"),
        burn.alias("avg_weekly_burn"),
        F.col("runway").cast("bigint").alias("weeks_of_runway"))
