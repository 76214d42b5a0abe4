"""From transaction date to cash date by payment rule, and seasonality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import (DateLike, date_lit, is_weekend, next_weekday,
                                      previous_weekday)
from tillflow.functions.money import from_units, money_sum, units

# Monthly revenue factors of the holiday-peaked pattern.
PEAK_MONTHS, PEAK_FACTOR = [10, 11, 12], 2.5
LOW_MONTHS, LOW_FACTOR = [1, 2, 3], 0.6

# Start of the first settlement period unless the caller names another.
SETTLEMENT_ANCHOR = "1970-01-01"


WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def settlement_end(day: Column, period_days: Column, anchor: Column) -> Column:
    """Last day of the settlement period that contains ``day``."""
    periods = F.floor(F.datediff(day, anchor) / period_days)
    return F.date_add(anchor, ((periods + 1) * period_days - 1).cast("int"))


def unadjusted_cash_date(day: Column, anchor: Column) -> Column:
    """Settlement rules: end of the period plus lag.  Others: the day plus lag.

    Stored terms put the lag of any rule in either lag column.  A rule with neither
    and without payout days has an unknown lag: NULL.
    """
    period = F.col("settlement_period_days")
    has_days = F.col("payout_days").isNotNull() | F.col("payout_day_of_month").isNotNull()
    lag = F.coalesce("lag_days", "settlement_lag_days", F.when(has_days, F.lit(0))).cast("int")
    settlement_lag = F.coalesce("settlement_lag_days", "lag_days", F.lit(0)).cast("int")
    return (F.when(period.isNotNull(),
                   F.date_add(settlement_end(day, period, anchor), settlement_lag))
            .otherwise(F.date_add(day, lag)))


def on_payout_day(day: Column) -> Column:
    """The first payout day on or after ``day``.

    ``payout_days`` lists weekday names or days of the month ("15"); a day beyond the
    month's end means its last day.  ``payout_day_of_month`` is one such day.
    """
    def of_month(number: Column) -> Column:
        this = F.date_add(F.trunc(day, "MM"), F.least(number, F.dayofmonth(F.last_day(day))) - 1)
        following = F.add_months(F.trunc(day, "MM"), 1)
        later = F.date_add(following, F.least(number, F.dayofmonth(F.last_day(following))) - 1)
        return F.when(number.isNotNull(), F.when(this >= day, this).otherwise(later))

    def named(name: Column) -> Column:
        place = F.array_position(F.array(*map(F.lit, WEEKDAYS)), name).cast("int")
        return (F.when(place > 0, F.date_add(day, F.pmod(place - 1 - F.weekday(day), F.lit(7))))
                .otherwise(of_month(name.try_cast("int"))))

    return F.coalesce(F.array_min(F.transform("payout_days", named)),
                      of_month(F.col("payout_day_of_month").cast("int")), day)


def _business_number(day: Column) -> Column:
    """Number of a weekday among all weekdays, from 1970-01-05, a Monday."""
    return F.floor(F.datediff(day, date_lit("1970-01-05")) / 7) * 5 + F.weekday(day)


def after_holidays(holidays: DataFrame) -> DataFrame:
    """(day, next_business_day) for every holiday on a weekday.

    Successive weekdays off form an island: their business-day numbers grow as their
    row numbers do.  The window is over the holiday list alone, bounded by the calendar.
    """
    days = holidays.select(F.col("holiday").alias("day")).distinct().where(~is_weekend(F.col("day")))
    number = _business_number(F.col("day"))
    islands = days.select("day", number.alias("number"),
                          (number - F.row_number().over(Window.orderBy("day"))).alias("island"))
    last = F.max("number").over(Window.partitionBy("island")) + 1
    monday = F.date_add(date_lit("1970-01-05"), (F.floor(last / 5) * 7 + F.pmod(last, F.lit(5))).cast("int"))
    return islands.select("day", monday.alias("next_business_day"))


# Timings that follow an event of the channel, and the kind of event.
WITH_EVENT = {"with_settlement": "settlement", "with_payout": "payout"}


def next_event(rows: DataFrame, events: DataFrame, by: Sequence[str], date: str) -> DataFrame:
    """(``by``, ``date``, next_event): the first event on or after each date of ``rows``.

    An as-of join on days.  ``events`` has the columns ``by`` and ``event_date``; NULL keys
    are equal.  Both sides are first cut to their distinct days, which the calendar bounds
    for every key, however many rows a channel has; then one ordered window per key walks
    from the last day back and carries the nearest event.
    """
    keys = [F.col(c) for c in by]
    asked = rows.select(*keys, F.col(date).alias("_day")).distinct().withColumn("event_date", F.lit(None).cast("date"))
    known = events.select(*keys, F.col("event_date").alias("_day"), "event_date").where("_day IS NOT NULL").distinct()
    # on one day events come before the rows that look for them
    back = (Window.partitionBy(*by).orderBy(F.col("_day").desc(), F.col("event_date").desc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = asked.unionByName(known).withColumn("next_event", F.min("event_date").over(back))
    return found.where("event_date IS NULL").select(*keys, F.col("_day").alias(date), "next_event")


def apply_payment_timing(rows: DataFrame, rules: DataFrame, rule: str = "term_id",
                         date: str = "transaction_date", anchor: DateLike = SETTLEMENT_ANCHOR,
                         holidays: DataFrame | None = None, events: DataFrame | None = None,
                         channel: str = "channel") -> DataFrame:
    """Add ``cash_date`` to rows that name a payment rule.

    Rows without a rule keep their date; a rule whose lag is unknown gives NULL.  A rule
    may have its own ``settlement_anchor``.  ``holidays`` moves dates of next-business-day
    rules off holidays.

    ``events`` (channel, event_kind, event_date) holds actual settlements and payouts.  A rule
    whose ``payment_timing`` is with_settlement or with_payout then takes the next such date of
    the row's ``channel``, on or after the row's date and as it is, without any move off
    weekends; where none is known yet the rule's estimate stands.
    """
    def own(name: str, kind: str) -> Column:
        return (F.col(name) if name in rules.columns else F.lit(None)).cast(kind).alias(name)

    terms = rules.select(F.col("term_id").alias("_term"), "lag_days", "settlement_period_days",
                         "settlement_lag_days", "weekend_handling",
                         own("payout_days", "array<string>"), own("payout_day_of_month", "int"),
                         own("settlement_anchor", "date"), own("payment_timing", "string"))
    start = F.coalesce("settlement_anchor", date_lit(anchor))
    handling = F.col("weekend_handling")
    plain = (F.when(F.col("_term").isNull(), F.col(date))
             .otherwise(on_payout_day(F.col("_plain"))))
    dated = (rows.join(terms, F.col(rule) == F.col("_term"), "left")
             .withColumn("_plain", unadjusted_cash_date(F.col(date), start))
             .withColumn("_plain", plain)
             .withColumn("cash_date",
                         F.when(handling == "Next Business Day", next_weekday(F.col("_plain")))
                         .when(handling == "Previous Business Day",
                               previous_weekday(F.col("_plain")))
                         .otherwise(F.col("_plain"))))
    if holidays is not None:
        dated = (dated.join(after_holidays(holidays), F.col("cash_date") == F.col("day"), "left")
                 .withColumn("cash_date",
                             F.when(handling == "Next Business Day",
                                    F.coalesce("next_business_day", "cash_date"))
                             .otherwise(F.col("cash_date")))
                 .drop("day", "next_business_day"))
    if events is not None:
        dated = _with_actual_dates(dated, events, date, channel)
    return dated.select(*rows.columns, "cash_date")


def _with_actual_dates(dated: DataFrame, events: DataFrame, date: str, channel: str) -> DataFrame:
    """``cash_date`` replaced by the next event of rules that pay with one."""
    kind = F.lit(None)
    for timing, event in WITH_EVENT.items():
        kind = F.when(F.col("payment_timing") == timing, event).otherwise(kind)
    dated = dated.withColumn("_kind", kind).withColumn("_channel", F.col(channel))
    happened = events.select(F.col("channel").alias("_channel"), F.col("event_kind").alias("_kind"), "event_date")
    found = next_event(dated.where("_kind IS NOT NULL"), happened, ["_channel", "_kind"], date)
    found = found.select(F.col("_channel").alias("_c"), F.col("_kind").alias("_k"),
                         F.col(date).alias("_d"), "next_event")
    same = (F.col("_channel").eqNullSafe(F.col("_c")) & (F.col("_kind") == F.col("_k"))
            & (F.col(date) == F.col("_d")))
    return dated.join(found, same, "left").withColumn("cash_date", F.coalesce("next_event", "cash_date"))


def settlement_events(settled: DataFrame) -> DataFrame:
    """Settlements that have paid, as events of their platform."""
    return settled.select(F.col("platform").alias("channel"), F.lit("settlement").alias("event_kind"),
                          F.col("cash_date").alias("event_date")).distinct()


def payout_events(payouts: DataFrame, channel: str) -> DataFrame:
    """Payouts of ``payout_settlement`` as events of one channel."""
    return payouts.select(F.lit(channel).alias("channel"), F.lit("payout").alias("event_kind"),
                          F.col("payout_date").alias("event_date")).distinct()


def seasonal_factor(day: Column) -> Column:
    month = F.month(day)
    return (F.when(month.isin(PEAK_MONTHS), PEAK_FACTOR)
            .when(month.isin(LOW_MONTHS), LOW_FACTOR).otherwise(1.0))


def seasonal_revenue(rows: DataFrame, date: str, amount: str) -> DataFrame:
    """Rows with their month's factor and the adjusted amount."""
    return (rows.withColumn("seasonal_factor", seasonal_factor(F.col(date)))
            .withColumn("seasonal_amount",
                        from_units(units(F.col(amount) * F.col("seasonal_factor")))))


def payout_settlement(lines: DataFrame) -> DataFrame:
    """Processor payouts: what was charged, what it cost and how long it took."""
    day = F.to_date("transaction_time")
    return (lines.groupBy("payout_id", "payout_date")
            .agg(F.count(F.lit(1)).alias("charge_count"),
                 money_sum("amount").alias("gross_amount"), money_sum("fee").alias("fee_amount"),
                 money_sum("net").alias("net_amount"), F.min(day).alias("first_charge"),
                 F.max(day).alias("last_charge"))
            .withColumn("lag_days", F.datediff("payout_date", "last_charge"))
            .withColumn("max_lag_days", F.datediff("payout_date", "first_charge")))
