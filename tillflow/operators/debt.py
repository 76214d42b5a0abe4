"""Payment schedules for whole tables of loans.

A schedule follows from closed forms, so each loan row explodes into its
payments in one narrow stage, dealt over the tasks once; no state between payments.  With
``i`` the monthly rate, ``B`` the balance when a phase starts and ``k`` the
payments made in that phase:

* level payments over N months leave  ``B ((1+i)^N - (1+i)^k) / ((1+i)^N - 1)``
* a fixed payment ``p`` leaves        ``B (1+i)^k - p ((1+i)^k - 1) / i``

Both have their own form at rate zero.  Amounts are rounded to cents in the
output only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import DateLike, date_lit
from tillflow.functions.money import cents, from_units, money_sum, units
from tillflow.functions.partitions import spread

# The day-count convention.
DAYS_IN_YEAR = 360
DAYS_IN_PERIOD = 30

LOAN_FIELDS = ["loan_id", "loan_name", "lender", "current_balance", "annual_rate",
               "payment_day", "start_date", "maturity_date", "io_months", "amort_months",
               "fixed_payment", "balloon_amount"]


def monthly_interest(principal: Column, annual_rate: Column,
                     days: int = DAYS_IN_PERIOD) -> Column:
    return principal * (annual_rate / DAYS_IN_YEAR) * days


def level_payment(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Annuity payment; the whole principal at 0 months, equal parts at rate 0."""
    rate = annual_rate / 12
    growth = F.pow(1 + rate, months.cast("double"))
    return (F.when(months == 0, principal)
            .when(rate == 0, principal / F.nullif(months, F.lit(0)))
            .otherwise(principal * (rate * growth) / F.nullif(growth - 1, F.lit(0.0))))


# The schedules below are SQL expressions: one call per expression into the JVM
# instead of one per operator keeps the driver's share of the work small.

def _date_after(months: str) -> str:
    """``months`` after start_date, on payment_day or the month's last day."""
    month = f"trunc(add_months(start_date, {months}), 'MM')"
    return f"date_add({month}, least(payment_day, dayofmonth(last_day({month}))) - 1)"


def _cents(name: str) -> str:
    """Half away from zero to two decimals; see ``functions.money.cents``."""
    size = f"floor(abs({name}) * 100 + 0.5D) / 100.0D"
    return f"CASE WHEN {name} < 0 THEN -({size}) ELSE {size} END + 0.0D"


def _level_balance(k: str) -> str:
    """Balance after ``k`` level payments."""
    base, months = "(1 + annual_rate / 12)", "CAST(amort_months AS DOUBLE)"
    return f"""CASE WHEN {k} >= amort_months THEN 0.0D
        WHEN annual_rate = 0 THEN current_balance * (1 - {k} / nullif({months}, 0.0D))
        ELSE current_balance * ((pow({base}, {months}) - pow({base}, {k}))
                                / nullif(pow({base}, {months}) - 1, 0.0D)) END"""


# Balance after k fixed payments, before any floor at zero.
FIXED_BALANCE = """CASE WHEN annual_rate = 0 THEN current_balance - fixed_payment * k
    ELSE current_balance * pow(1 + annual_rate / 12, k)
         - fixed_payment * (pow(1 + annual_rate / 12, k) - 1) / nullif(annual_rate / 12, 0.0D) END"""

INTEREST = f"beginning * (annual_rate / {DAYS_IN_YEAR}) * {DAYS_IN_PERIOD}"

# Payment dates fall in consecutive months, so only the date in maturity's own
# month needs a comparison to count those before maturity, or up to it.
_MONTHS = ("((year(maturity_date) - year(start_date)) * 12 "
           "+ month(maturity_date) - month(start_date))")
DATES_BEFORE_MATURITY = f"greatest({_MONTHS} + int({_date_after(_MONTHS)} < maturity_date), 0)"
DATES_UP_TO_MATURITY = f"greatest({_MONTHS} + int({_date_after(_MONTHS)} <= maturity_date), 0)"

# Something is owed in whole cents; the noise of the closed form lies far below a
# cent for balances up to 1e12.
STILL_OWED = "floor(beginning * 100 + 0.5D) > 0"


def _steps(rows: DataFrame, count: str, first: int = 0) -> DataFrame:
    """``count`` numbered copies of every row, in ``step`` from ``first`` on.

    Loans are few and narrow next to their payments: one block of a file may hold them all, so
    they are dealt over the tasks first.
    """
    numbers = (f"CASE WHEN {count} > 0 THEN sequence({first}, {count} - 1 + {first}) "
               "ELSE CAST(array() AS array<int>) END")
    return rows.repartition("loan_id").selectExpr("*", f"explode({numbers}) AS step")


def payment_dates(loans: DataFrame, payments: int) -> DataFrame:
    """(loan_id, payment_number, payment_date) for the first ``payments`` months."""
    return _steps(loans, str(payments), 1).selectExpr(
        "loan_id", "step AS payment_number", f"{_date_after('step - 1')} AS payment_date")


def _payments(loans: DataFrame, count: str) -> DataFrame:
    """The ``count`` payments after the interest-only phase; ``k`` were made before."""
    return _steps(loans.select(*LOAN_FIELDS), count).selectExpr(
        "*", "io_months + step + 1 AS payment_number", "CAST(step AS DOUBLE) AS k",
        f"{_date_after('(io_months + step)')} AS payment_date")


def _staged(rows: DataFrame, *stages: dict[str, str]) -> DataFrame:
    """Add columns stage by stage, so that Catalyst computes each one once."""
    for stage in stages:
        rows = rows.withColumns({name: F.expr(text) for name, text in stage.items()})
    return rows


def _rows(payments: DataFrame, payment_type: str) -> DataFrame:
    """Output columns from the working columns beginning .. ending."""
    amounts = {"payment_amount": "payment", "principal_amount": "principal",
               "interest_amount": "interest", "beginning_principal": "beginning",
               "ending_principal": "ending"}
    rounded = {name: f"{_cents(source)} AS {name}" for name, source in amounts.items()}
    return payments.selectExpr(
        "loan_id", "loan_name", "lender", "payment_date", "payment_number",
        rounded["payment_amount"], rounded["principal_amount"], rounded["interest_amount"],
        "0.0D AS fees_amount", rounded["beginning_principal"], rounded["ending_principal"],
        "annual_rate AS interest_rate", f"{DAYS_IN_PERIOD} AS days_in_period",
        f"'{payment_type}' AS payment_type")


def schedule_interest_only(loans: DataFrame) -> DataFrame:
    """The first ``io_months`` payments: interest on an unchanged balance."""
    paid = _steps(loans.select(*LOAN_FIELDS), "io_months", 1).selectExpr(
        "*", "step AS payment_number", f"{_date_after('(step - 1)')} AS payment_date",
        "current_balance AS beginning", "current_balance AS ending", "0.0D AS principal")
    return _rows(_staged(paid, {"interest": INTEREST}, {"payment": "interest"}), "Interest Only")


def schedule_amortising(loans: DataFrame, to_maturity: bool = False,
                        numbered_after: str | None = None) -> DataFrame:
    """``amort_months`` level payments after the interest-only phase.

    ``to_maturity`` leaves out those whose cycle date lies after ``maturity_date``.
    ``numbered_after`` names a column with the number of payments made before the loan's own.
    """
    before = [numbered_after] if numbered_after else []
    level = level_payment(F.col("current_balance"), F.col("annual_rate"), F.col("amort_months"))
    due = loans.select(*LOAN_FIELDS, *before, level.alias("level")).where("amort_months > 0")
    steps = _steps(due, "amort_months")
    if to_maturity:
        steps = steps.where("coalesce(add_months(start_date, io_months + step) <= maturity_date, true)")
    payments = steps.selectExpr(
        "*", " + ".join(["io_months + step + 1", *before]) + " AS payment_number", "CAST(step AS DOUBLE) AS k",
        f"{_date_after('(io_months + step)')} AS payment_date")
    paid = _staged(payments,
                   {"beginning": _level_balance("k"), "ending": _level_balance("(k + 1)")},
                   {"interest": INTEREST},
                   {"principal": "least(level - interest, beginning)"},
                   {"payment": "principal + interest"})
    return _rows(paid, "Principal & Interest")


def schedule_fixed_payment(loans: DataFrame) -> DataFrame:
    """Fixed payments until the balance is gone or maturity has passed.

    The maturity test looks at the previous payment's date, the start date for
    the first one; so one payment may fall after maturity.  A payment below
    the interest makes the balance grow.
    """
    fixed = loans.where("coalesce(amort_months, 0) = 0 AND fixed_payment IS NOT NULL "
                        "AND balloon_amount IS NULL AND start_date <= maturity_date")
    count = f"(greatest({DATES_UP_TO_MATURITY} - io_months, 0) + 1)"
    due = _staged(_payments(fixed, count), {"beginning": FIXED_BALANCE}).where(STILL_OWED)
    paid = _staged(due, {"interest": INTEREST},
                   {"principal": "least(fixed_payment - interest, beginning)"},
                   {"payment": "principal + interest",
                    "ending": "greatest(0.0D, beginning - principal)"})
    return _rows(paid, "Fixed Payment")


def schedule_balloon(loans: DataFrame) -> DataFrame:
    """Fixed payments strictly before maturity, then the balloon at maturity.

    The regular payment is never capped; a balance that reaches zero stays
    there.  The balloon row pays the configured amount whatever is owed.
    """
    balloon = loans.where("coalesce(amort_months, 0) = 0 AND balloon_amount IS NOT NULL")
    made = (f"(CASE WHEN start_date < maturity_date "
            f"THEN greatest({DATES_BEFORE_MATURITY} - io_months, 0) ELSE 0 END)")
    owed = {"beginning": f"greatest(0.0D, {FIXED_BALANCE})"}
    regular = _staged(_payments(balloon, made), owed, {"interest": INTEREST},
                      {"payment": "fixed_payment", "principal": "fixed_payment - interest"},
                      {"ending": "greatest(0.0D, beginning - principal)"})
    last = balloon.selectExpr(*LOAN_FIELDS, f"{made} AS made").selectExpr(
        *LOAN_FIELDS, "io_months + made + 1 AS payment_number", "CAST(made AS DOUBLE) AS k",
        "maturity_date AS payment_date")
    final = _staged(last, owed, {"interest": INTEREST},
                    {"payment": "balloon_amount", "principal": "beginning", "ending": "0.0D"})
    return _rows(regular, "Regular Payment").unionByName(_rows(final, "Balloon Payment"))


def loan_status(schedule: DataFrame, as_of: DateLike) -> DataFrame:
    """Payments before ``as_of`` count as paid, the others as forecast."""
    return (schedule.withColumn("is_paid", F.col("payment_date") < date_lit(as_of))
            .withColumn("is_forecast", F.col("payment_date") >= date_lit(as_of)))


def loan_schedule(loans: DataFrame, as_of: DateLike) -> DataFrame:
    """Every payment of every loan.

    After the interest-only phase a loan follows one structure: level payments
    when ``amort_months`` is positive, else the balloon when one is set, else
    the fixed payment.
    """
    rows = (schedule_interest_only(loans)
            .unionByName(schedule_amortising(loans))
            .unionByName(schedule_fixed_payment(loans))
            .unionByName(schedule_balloon(loans)))
    return loan_status(rows, as_of)


def schedule_revolver(loans: DataFrame, as_of: DateLike, to_maturity: bool = False) -> DataFrame:
    """Interest-only through ``io_end_date`` inclusive, then level payments.

    The cycle dates lie whole months after ``start_date``; one that falls on
    the end date still pays interest only.  ``to_maturity`` ends the level payments
    with the last cycle date up to ``maturity_date``, whatever is still owed.
    """
    months = F.floor(F.months_between("io_end_date", "start_date")) + 1
    phased = loans.withColumn("io_months", F.greatest(months, F.lit(0)).cast("int"))
    level = schedule_amortising(phased, to_maturity)
    return loan_status(schedule_interest_only(phased).unionByName(level), as_of)


# ---- variable-rate revolver -------------------------------------------------

def monthly_rates(rates: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """(rate_month, base_rate) for the months ``first`` to ``last``.

    ``rates`` gives effective_date and base_rate (yearly).  A month has the rate in force on
    its first day, which is when variable loans adjust; months before the first rate have the
    earliest one.  Of several rates of one day the highest counts.  The list is bounded by
    the calendar.
    """
    daily = rates.groupBy("effective_date").agg(F.max("base_rate").alias("base_rate"))
    in_order = Window.orderBy("effective_date")  # one row a rate change
    ends = F.trunc(F.date_sub(F.coalesce(F.lead("effective_date").over(in_order), F.add_months(date_lit(last), 1)), 1), "MM")
    # the first month whose opening day the rate covers
    begins = F.when(F.row_number().over(in_order) == 1, F.trunc(F.least("effective_date", date_lit(first)), "MM")) \
              .otherwise(F.trunc(F.add_months(F.date_sub("effective_date", 1), 1), "MM"))
    spans = daily.select("base_rate", begins.alias("begins"), ends.alias("ends")).where("begins <= ends")
    months = F.explode(F.sequence("begins", "ends", F.expr("interval 1 month")))
    return spans.select(months.alias("rate_month"), "base_rate")


def balance_spans(loans: DataFrame, movements: DataFrame) -> DataFrame:
    """(loan_id, span_start, span_end, units): the balance of each revolver over time.

    A span holds from its start up to the day before its end; the last one ends with the
    phase in which the loan revolves, ``io_end_date``.  ``movements`` are draws (positive) and
    repayments (negative) with loan_id, movement_date and amount; those of a day add up, those
    before the start, on the end date or later, or without a loan are left out.
    """
    phase = loans.select("loan_id", "start_date", "io_end_date", units("current_balance").alias("opening"))
    moved = (movements.groupBy(F.col("loan_id").alias("_loan"), "movement_date")
             .agg(F.sum(units("amount")).alias("net")))
    inside = (F.col("_loan") == F.col("loan_id")) & (F.col("movement_date") >= F.col("start_date")) \
        & (F.col("movement_date") < F.col("io_end_date"))
    changes = moved.join(phase, inside).select("loan_id", F.col("movement_date").alias("span_start"), "io_end_date", "net")
    opened = phase.where("start_date < io_end_date").select(
        "loan_id", F.col("start_date").alias("span_start"), "io_end_date", F.col("opening").alias("net"))
    daily = (changes.unionByName(opened).groupBy("loan_id", "span_start", "io_end_date")
             .agg(F.sum("net").alias("net")))
    order = Window.partitionBy("loan_id").orderBy("span_start")  # at most one row a day
    so_far = F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select("loan_id", "span_start",
                        F.coalesce(F.lead("span_start").over(order), F.col("io_end_date")).alias("span_end"),
                        so_far.alias("units"))


def revolver_interest(loans: DataFrame, movements: DataFrame, rates: DataFrame,
                      first: DateLike, last: DateLike) -> DataFrame:
    """Interest on daily balances, one row per loan and payment date of the revolving phase.

    A balance span is cut at month ends, where the rate may change, and at the payment day of
    each month, where a payment covers the days before it.  Within such a piece balance and
    rate are constant, so a payment's interest is the sum of at most two terms, days times
    balance in each of its two months, times that month's base rate plus the loan's ``spread``
    over 360.  The day sums are whole numbers and exact.  A credit balance bears none.
    ``first`` and ``last`` bound the months of the rate list; days outside them bear no
    interest, so choose them around all loans.  The rate shown is that of the payment's last
    month with a balance.
    """
    month = F.col("month")
    pay = F.date_add(month, F.least(F.col("payment_day"), F.dayofmonth(F.last_day(month))) - 1)
    spans = balance_spans(loans, movements)
    known = loans.select(F.col("loan_id").alias("_loan"), "payment_day", "spread", "io_end_date")
    months = F.explode(F.sequence(F.trunc("span_start", "MM"), F.trunc(F.date_sub("span_end", 1), "MM"),
                                  F.expr("interval 1 month")))
    pieces = (spans.where("span_start < span_end").join(known, F.col("loan_id") == F.col("_loan"))
              .withColumn("month", months).withColumn("pay", pay))
    # days of the span in the month, before the payment day and from it on
    opens, closes = F.greatest("span_start", "month"), F.least("span_end", F.add_months(month, 1))
    days = lambda low, high: F.greatest(F.datediff(high, low), F.lit(0))
    owed = F.greatest("units", F.lit(0).cast("bigint"))
    pieces = pieces.select(
        "loan_id", "month", "pay", "payment_day", "spread", "io_end_date",
        (owed * days(opens, F.least(closes, F.col("pay")))).alias("early"),
        (owed * days(F.greatest(opens, F.col("pay")), closes)).alias("late"))
    # dealt anew: all steps in one stage would hold their rows and buffers in one task at once
    sums = spread(pieces, "loan_id", "month").groupBy("loan_id", "month", "pay", "payment_day", "spread", "io_end_date").agg(
        F.sum("early").alias("early"), F.sum("late").alias("late"))
    rated = sums.join(monthly_rates(rates, first, last), month == F.col("rate_month"), "left")
    yearly = F.coalesce(F.col("base_rate") + F.col("spread"), F.lit(0.0))
    following = F.add_months(month, 1)
    next_pay = F.date_add(following, F.least(F.col("payment_day"), F.dayofmonth(F.last_day(following))) - 1)

    def part(name: str, date: Column) -> Column:
        interest = from_units(F.col(name)) * (yearly / DAYS_IN_YEAR)
        return F.struct(F.least(date, F.col("io_end_date")).alias("payment_date"), F.col("month").alias("of_month"),
                        interest.alias("interest"), yearly.alias("rate"), F.col(name).alias("unit_days"))

    parts = rated.select("loan_id", "io_end_date", F.inline(F.array(part("early", F.col("pay")), part("late", next_pay))))
    # a late term of the month before and an early one of its own: added in a fixed order
    ordered = F.array_sort(F.collect_list(F.struct("rate", "interest")))
    return (parts.where("unit_days > 0").groupBy("loan_id", "payment_date")
            .agg(ordered.alias("terms"), F.max_by("rate", "of_month").alias("interest_rate"))
            .select("loan_id", "payment_date", "interest_rate",
                    F.aggregate("terms", F.lit(0.0), lambda total, term: total + term["interest"]).alias("interest")))


def schedule_variable_revolver(loans: DataFrame, movements: DataFrame, rates: DataFrame, as_of: DateLike,
                               first: DateLike, last: DateLike) -> DataFrame:
    """A credit line with draws, repayments and a monthly base rate plus ``spread``.

    Until ``io_end_date`` interest on daily balances falls due on each payment day; what is
    open on the end date is due on it.  The balance of that day then amortises over
    ``amort_months`` level payments at the rate of its month.
    """
    spans = balance_spans(loans, movements)
    interest = spread(revolver_interest(loans, movements, rates, first, last), "loan_id")
    names = loans.select(F.col("loan_id").alias("_loan"), "loan_name", "lender")
    held = spans.select(F.col("loan_id").alias("_held"), "span_start", "span_end", F.col("units").alias("held"))
    # the span of the day before the payment: a loan's spans are few and meet its payments by key
    day = F.date_sub("payment_date", 1)
    paid = (interest.join(held, (F.col("loan_id") == F.col("_held")) & (day >= F.col("span_start"))
                          & (day < F.col("span_end")))
            .join(names, F.col("loan_id") == F.col("_loan"))
            .withColumn("payment_number", F.row_number().over(Window.partitionBy("loan_id").orderBy("payment_date"))))
    balance = from_units(F.col("held"))
    rows = paid.select(
        "loan_id", "loan_name", "lender", "payment_date", "payment_number", F.col("interest").alias("payment"),
        F.lit(0.0).alias("principal"), "interest", balance.alias("beginning"), balance.alias("ending"),
        F.col("interest_rate").alias("annual_rate"))
    revolving = _rows(rows, "Interest Only")
    # what is owed when the phase ends, at the rate of that month
    closing = spans.groupBy(F.col("loan_id").alias("_closed")).agg(F.max_by("units", "span_start").alias("owed"))
    counts = paid.groupBy(F.col("loan_id").alias("_counted")).agg(F.count(F.lit(1)).cast("int").alias("paid"))
    rated = loans.withColumn("_month", F.trunc("io_end_date", "MM")).join(
        monthly_rates(rates, first, last), F.col("_month") == F.col("rate_month"), "left")
    level = (rated.join(closing, F.col("loan_id") == F.col("_closed"))
             .join(counts, F.col("loan_id") == F.col("_counted"), "left")
             .withColumn("current_balance", from_units(F.greatest("owed", F.lit(0).cast("bigint"))))
             .withColumn("annual_rate", F.coalesce(F.col("base_rate") + F.col("spread"), F.lit(0.0)))
             .withColumn("start_date", F.add_months("io_end_date", 1)).withColumn("io_months", F.lit(0))
             .where("current_balance > 0"))
    numbers = level.select(F.col("loan_id").alias("_numbered"), F.coalesce("paid", F.lit(0)).alias("paid"))
    numbered = level.drop("paid").join(numbers, F.col("loan_id") == F.col("_numbered"))
    amortised = schedule_amortising(numbered, numbered_after="paid")
    return loan_status(revolving.unionByName(amortised), as_of)


def as_debt_rows(schedule: DataFrame, ids: str = "uuid") -> DataFrame:
    """Schedule rows with the id a stored row needs."""
    key = F.concat_ws("|", "loan_id", F.col("payment_number").cast("string"))
    return schedule.withColumn("schedule_id", F.uuid() if ids == "uuid" else F.sha2(key, 256))


# ---- reports over schedules -------------------------------------------------

def schedule_totals(schedule: DataFrame) -> DataFrame:
    return (schedule.groupBy("loan_id")
            .agg(money_sum("principal_amount").alias("total_principal"),
                 money_sum("interest_amount").alias("total_interest"),
                 money_sum("payment_amount").alias("total_payments"),
                 F.count(F.lit(1)).alias("payment_count")))


def debt_by_loan(schedule: DataFrame) -> DataFrame:
    return (schedule.groupBy("loan_name", "lender")
            .agg(F.count(F.lit(1)).alias("payment_count"),
                 F.min("payment_date").alias("first_payment"),
                 F.max("payment_date").alias("last_payment"),
                 money_sum("payment_amount").alias("total_payments"),
                 money_sum("principal_amount").alias("total_principal"),
                 money_sum("interest_amount").alias("total_interest"))
            .orderBy("loan_name", "lender"))


def upcoming_payments(schedule: DataFrame, as_of: DateLike, weeks: int = 13) -> DataFrame:
    """Unpaid payments of the next weeks, both ends included."""
    day = F.col("payment_date")
    due = schedule.where(~F.col("is_paid") & (day >= date_lit(as_of))
                         & (day <= F.date_add(date_lit(as_of), 7 * weeks)))
    return (due.select("payment_date", "loan_name", "payment_type",
                       cents(F.col("payment_amount")).alias("payment"),
                       cents(F.col("principal_amount")).alias("principal"),
                       cents(F.col("interest_amount")).alias("interest"),
                       cents(F.col("ending_principal")).alias("remaining_balance"))
            .orderBy("payment_date", "loan_name"))


def loan_payments(schedule: DataFrame, loan_id: str, limit: int = 20) -> DataFrame:
    """First payments of one loan."""
    return (schedule.where(F.col("loan_id") == loan_id)
            .select("payment_date", "payment_number",
                    cents(F.col("payment_amount")).alias("payment"),
                    cents(F.col("principal_amount")).alias("principal"),
                    cents(F.col("interest_amount")).alias("interest"),
                    cents(F.col("ending_principal")).alias("balance"))
            .orderBy("payment_date", "payment_number").limit(limit))


def active_loan_summary(schedule: DataFrame) -> DataFrame:
    """Unpaid rows per loan."""
    return (schedule.where(~F.col("is_paid"))
            .groupBy("loan_name", "lender")
            .agg(F.count(F.lit(1)).alias("total_payments"),
                 money_sum("payment_amount").alias("total_payments_amount"),
                 F.max("payment_date").alias("final_payment_date"))
            .orderBy("loan_name", "lender"))
