"""Chart of accounts, general ledger, balances and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import DateLike, date_lit, month_start
from tillflow.functions.money import from_units, inflow_sum, money_sum, outflow_sum, units
from tillflow.functions.partitions import spread
from tillflow.operators.etl import DEFAULT_ACCOUNT, as_ledger, row_id

UNMAPPED = "Unclassified"


NON_CASH_SECTIONS = ["non_cash_items", "clearing_accounts"]


def _section_name(section: Column) -> Column:
    return (F.when(section.startswith("operating") | (section == "cogs"), "Operating")
            .when(section.startswith("investing"), "Investing")
            .when(section.startswith("financing"), "Financing")
            .when(section == "non_cash_items", "Non-Cash")
            .when(section == "clearing_accounts", "Clearing"))


def _directed(category_map: DataFrame) -> DataFrame:
    """The map with its rule, direction and place.

    ``position`` is the order of the configuration; a map without it is ordered by
    section, category and subcategory.
    """
    section = F.col("section")
    position = F.col("position") if "position" in category_map.columns else F.lit(0)
    rule = F.struct(_section_name(section).alias("section"), F.col("category"),
                    F.col("subcategory"), F.col("cash_timing"),
                    (~section.isin(NON_CASH_SECTIONS)).alias("is_cash"))
    return category_map.select(
        F.col("account_number").alias("number"), F.col("account").alias("leaf"),
        section.endswith("inflows").alias("is_in"), rule.alias("rule"),
        F.struct(position.alias("position"), section.alias("s"), F.col("category").alias("c"),
                 F.col("subcategory").alias("u")).alias("place"))


def _first_rules() -> list[Column]:
    is_in = F.col("is_in")
    return [F.min_by(F.when(is_in, F.col("rule")), F.when(is_in, F.col("place"))).alias("in_rule"),
            F.min_by(F.when(~is_in, F.col("rule")), F.when(~is_in, F.col("place"))).alias("out_rule")]


def category_rules(category_map: DataFrame) -> DataFrame:
    """One row per account with its rule for inflows and for outflows.

    An account may be listed under an inflow and an outflow section.  Folding
    both into one row keeps every later join free of fan-out.  Of several rules in one
    direction the first of the configuration counts; ``rule_conflicts`` lists the others.
    """
    return _directed(category_map).groupBy("number", "leaf").agg(*_first_rules())


def rule_conflicts(category_map: DataFrame) -> DataFrame:
    """Accounts with several rules in one direction: the rule that counts and the others."""
    ordered = F.array_sort(F.collect_list(F.struct("place", "rule")))
    rules = (_directed(category_map).groupBy("number", "leaf", "is_in").agg(ordered.alias("all"))
             .where(F.size("all") > 1))
    return rules.select("number", "leaf", F.when(F.col("is_in"), "inflow").otherwise("outflow").alias("direction"),
                        F.col("all")[0]["rule"].alias("used"),
                        F.transform(F.slice("all", 2, F.size("all") - 1), lambda x: x["rule"]).alias("unused"))


def _matched(rows: DataFrame, category_map: DataFrame, number: Column, name: Column) -> DataFrame:
    """``rows`` with ``in_rule`` and ``out_rule``, by number, else full name, else leaf.

    The map becomes one table by a single key.  A row looks up the best key that the map
    knows; which ones it knows is a property of few keys, so the fact rows are joined once.
    """
    rules = _directed(category_map)
    keyed = rules.select("*", F.explode(F.array(
        F.when(F.col("number").isNotNull(), F.concat(F.lit("number:"), "number")),
        F.concat(F.lit("name:"), "leaf"))).alias("_key")).where("_key IS NOT NULL")
    by_key = keyed.groupBy("_key").agg(*_first_rules())
    keys = F.array(F.concat(F.lit("number:"), number), F.concat(F.lit("name:"), name),
                   F.concat(F.lit("name:"), leaf_name(name)))
    # accounts are few beside their rows: resolve each distinct account once
    accounts = rows.select(number.alias("_number"), name.alias("_name"), keys.alias("_keys")).distinct()
    found = (accounts.select("_number", "_name", F.posexplode("_keys").alias("_at", "_key"))
             .where("_key IS NOT NULL").join(by_key, "_key")
             .groupBy("_number", "_name")
             .agg(F.min_by(F.struct("in_rule", "out_rule"), "_at").alias("_rules")))
    # a NULL number has a stand-in that matches itself only, spread by the name
    plain = F.concat_ws("|", F.coalesce(F.concat(F.lit("n"), number), F.lit("-")), name)
    found = found.select(F.concat_ws("|", F.coalesce(F.concat(F.lit("n"), "_number"), F.lit("-")), "_name")
                         .alias("_found"), "_rules")
    joined = rows.withColumn("_leaf", leaf_name(name)).join(found, plain == F.col("_found"), "left")
    return joined.select(*rows.columns, "_leaf", F.col("_rules.in_rule").alias("in_rule"),
                         F.col("_rules.out_rule").alias("out_rule"))


def leaf_name(full_name: Column) -> Column:
    return F.element_at(F.split(full_name, ":"), -1)


def map_accounts(accounts: DataFrame, category_map: DataFrame) -> DataFrame:
    """Chart of accounts with hierarchy and cash-flow rule, one row per account.

    An account with rules for both directions shows the outflow rule and, in
    ``inflow_category``, the category of its inflows.
    """
    name = F.col("full_name")
    parts = F.split(name, ":")
    matched = _matched(accounts, category_map, F.col("account_number"), name)
    rule = F.coalesce("out_rule", "in_rule")
    return matched.select(
        "account_number", "full_name", F.col("_leaf").alias("account_name"),
        F.size(parts).cast("bigint").alias("account_level"),
        F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), ":"))
         .alias("parent_name"),
        "account_type",
        rule["section"].alias("cash_flow_section"), rule["category"].alias("cash_flow_category"),
        rule["subcategory"].alias("cash_flow_subcategory"),
        rule["cash_timing"].alias("default_payment_timing"),
        F.col("in_rule.category").alias("inflow_category"),
        F.coalesce(rule["is_cash"], F.lit(True)).alias("is_cash_account"))


def gl_to_ledger(gl: DataFrame, category_map: DataFrame, ids: str = "uuid",
                 account: tuple[str, str] = DEFAULT_ACCOUNT) -> DataFrame:
    """General-ledger rows of cash accounts as ledger rows.

    A debit (positive) takes cash, so the sign turns around.  The direction
    picks the rule when an account has one for each.  Accounts without a rule
    stay in the ledger as unclassified; non-cash accounts leave it.
    """
    amount = 0.0 - F.col("amount")
    matched = _matched(gl, category_map, F.col("account_number"), F.col("account_name"))
    rule = F.when(amount > 0, F.coalesce("in_rule", "out_rule")) \
            .otherwise(F.coalesce("out_rule", "in_rule"))
    cash = matched.withColumn("rule", rule).where("coalesce(rule.is_cash, true)")
    day = F.col("transaction_date")
    return as_ledger(cash.select(
        row_id(ids, F.lit("gl"), F.col("entry_id"), day.cast("string"),
               F.col("account_name"), units("amount").cast("string")).alias("transaction_id"),
        day.alias("transaction_date"), day.alias("cash_date"), day.alias("value_date"),
        F.lit("gl").alias("source_system"), F.col("entry_id").alias("source_id"),
        F.lit("gl_transactions").alias("source_table"),
        F.lit(account[0]).alias("bank_account_id"), F.lit(account[1]).alias("bank_account_name"),
        F.coalesce("rule.section", F.lit(UNMAPPED)).alias("cash_flow_section"),
        F.coalesce("rule.category", F.lit(UNMAPPED)).alias("cash_flow_category"),
        F.col("rule.subcategory").alias("cash_flow_subcategory"),
        amount.alias("amount"), F.col("vendor").alias("counterparty"),
        F.when(F.col("vendor").isNotNull(), "Vendor").alias("counterparty_type"),
        F.col("transaction_type").alias("description"), F.lit("etl_gl").alias("created_by")))


BALANCE_COLUMNS = ["balance_date", "bank_account_id", "account_type", "beginning_balance", "ending_balance",
                   "total_inflows", "total_outflows", "net_change", "credit_limit", "available_credit"]


def _flows(rows: DataFrame, *by: str) -> DataFrame:
    """Ledger rows summed to (account, day), with ``by`` in front."""
    return (rows.groupBy(*by, "bank_account_id", F.col("cash_date").alias("balance_date"))
            .agg(inflow_sum("amount").alias("total_inflows"),
                 outflow_sum("amount").alias("total_outflows"),
                 F.sum(units("amount")).alias("net")))


def _running(daily: DataFrame, last: Column, accounts: DataFrame, *by: str) -> DataFrame:
    """``daily`` with the sum of net until then in ``so_far``, the last idle day after it in
    ``until`` (at most ``last``) and its account's type, opening and limit.

    Each row stands for its days until ``_days`` makes them, so joins belong before that.  The
    number of tasks is the session's: few rows come in, but all days go out.
    """
    order = Window.partitionBy(*by, "bank_account_id").orderBy("balance_date")
    running = spread(daily, "bank_account_id").select(
        "*", F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("so_far"),
        F.coalesce(F.date_sub(F.lead("balance_date").over(order), 1), last).alias("until"))
    known = accounts.select(F.col("account_id").alias("_id"), "account_type",
                            "opening_balance", "credit_limit")
    return running.join(known, F.col("bank_account_id") == F.col("_id"), "left")


def _days(running: DataFrame) -> DataFrame:
    """A row for each day of ``running``; idle days have no flows."""
    days = F.explode(F.sequence("balance_date", F.greatest("until", "balance_date")))
    active = F.col("day") == F.col("balance_date")
    flow = lambda name, none: F.when(active, F.col(name)).otherwise(none)
    return running.select("*", days.alias("day")).withColumns({
        "balance_date": F.col("day"),
        "total_inflows": flow("total_inflows", F.lit(0.0)), "total_outflows": flow("total_outflows", F.lit(0.0)),
        "net": flow("net", F.lit(0).cast("long"))}).drop("day", "until")


def _balances(days: DataFrame, base: Column) -> DataFrame:
    """Balance rows from ``days``; ``base`` is the balance before the first of them, in units."""
    ending = base + F.col("so_far")
    return days.select(
        "*", from_units(ending - F.col("net")).alias("beginning_balance"),
        from_units(ending).alias("ending_balance"), from_units(F.col("net")).alias("net_change"),
        F.when(F.col("account_type") == "LOC", from_units(units("credit_limit") - ending))
         .alias("available_credit"))


def _opening() -> Column:
    return units(F.coalesce("opening_balance", F.lit(0.0)))


def daily_balances(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Opening, flows and closing per account and day, from actual rows.

    ``accounts`` gives account_id, account_type, opening_balance and
    credit_limit.  Every account has a row for each day from its first movement to the
    last day of the whole ledger; idle days carry the closing forward.
    """
    actual = ledger.where(~F.col("is_forecast"))
    last = actual.agg(F.max("cash_date")).scalar()
    return _balances(_days(_running(_flows(actual), last, accounts)), _opening()).select(*BALANCE_COLUMNS)


def updated_daily_balances(stored: DataFrame, ledger: DataFrame, accounts: DataFrame,
                           since: DateLike) -> DataFrame:
    """``stored`` daily balances with the days from ``since`` on made anew.

    Equals ``daily_balances`` of the whole ledger if no row before ``since`` has changed, but
    reads and sums only rows from ``since`` on: each account goes on from its last stored
    closing before.  With a late row, name its day.
    """
    first = date_lit(since)
    actual = ledger.where(~F.col("is_forecast") & (F.col("cash_date") >= first))
    kept = stored.where(F.col("balance_date") < first)
    known = kept.agg(F.max("balance_date")).scalar()
    closing = kept.where(F.col("balance_date") == known).select(
        F.col("bank_account_id").alias("_account"), units("ending_balance").alias("_closing"))
    # a row without movement on the next day carries an account that stays idle
    none = F.lit(0.0)
    carried = closing.select(F.col("_account").alias("bank_account_id"),
                             F.date_add(known, 1).alias("balance_date"),
                             none.alias("total_inflows"), none.alias("total_outflows"),
                             F.lit(0).cast("long").alias("net"))
    daily = _merged(_flows(actual).unionByName(carried))
    last = actual.agg(F.max("cash_date")).scalar()
    running = _running(daily, F.greatest(last, known), accounts).join(
        closing, F.col("bank_account_id") == F.col("_account"), "left")
    days = _days(running).where(F.col("balance_date") <= F.coalesce(F.greatest(last, known), first))
    fresh = _balances(days, F.coalesce("_closing", _opening()))
    return kept.select(*BALANCE_COLUMNS).unionByName(fresh.select(*BALANCE_COLUMNS))


def _merged(daily: DataFrame, *by: str) -> DataFrame:
    """One row per account and day of partly summed flows."""
    return daily.groupBy(*by, "bank_account_id", "balance_date").agg(
        money_sum("total_inflows").alias("total_inflows"),
        money_sum("total_outflows").alias("total_outflows"), F.sum("net").alias("net"))


def scenario_balances(ledger: DataFrame, accounts: DataFrame, as_of: DateLike | None = None) -> DataFrame:
    """Daily balances of the forecast, per scenario: the rows of ``daily_balances`` with
    is_forecast (true) and scenario_id.

    Each scenario goes on from every account's last actual closing, from the day after the
    last actual day to the last forecast day of the ledger.  Forecast rows up to the last actual
    day are history that the actuals replace.  With ``as_of`` only actual rows before that day
    are known, and the forecast begins on it.  Rows without a scenario form the scenario NULL.
    The actual side is one sum per account; its days are not made.
    """
    actual = ledger.where(~F.col("is_forecast"))
    last = actual.agg(F.max("cash_date")).scalar()
    if as_of is not None:
        actual = actual.where(F.col("cash_date") < date_lit(as_of))
        last = F.date_sub(date_lit(as_of), 1)
    planned = ledger.where(F.col("is_forecast") & F.coalesce(F.col("cash_date") > last, F.lit(True)))
    span = planned.agg(F.min("cash_date").alias("first"), F.max("cash_date").alias("end"),
                       F.sort_array(F.collect_set(F.struct("scenario_id"))).alias("scenarios"))
    names, end = span.select("scenarios").scalar(), span.select("end").scalar()
    first = F.coalesce(F.date_add(last, 1), span.select("first").scalar())
    moved = actual.groupBy("bank_account_id").agg(F.sum(units("amount")).alias("moved"))
    none = F.lit(0.0)
    carried = moved.select(F.inline(names), "bank_account_id").select(
        "scenario_id", "bank_account_id", first.alias("balance_date"), none.alias("total_inflows"),
        none.alias("total_outflows"), F.lit(0).cast("long").alias("net"))
    daily = _merged(_flows(planned, "scenario_id").unionByName(carried), "scenario_id")
    running = _running(daily, end, accounts, "scenario_id").join(
        moved.withColumnRenamed("bank_account_id", "_account"),
        F.col("bank_account_id") == F.col("_account"), "left")
    base = _opening() + F.coalesce("moved", F.lit(0))
    return _balances(_days(running), base).select(
        *BALANCE_COLUMNS, F.lit(True).alias("is_forecast"), "scenario_id")


# Period types of budgets; here with the unit that their start is cut to.
PERIODS = {"Monthly": "MM", "Quarterly": "QUARTER", "Annual": "YEAR"}


def _period_start(kind: Column, day: Column) -> Column:
    out = day
    for name, unit in PERIODS.items():
        out = F.when(kind == name, F.trunc(day, unit)).otherwise(out)
    return out


def _or(frame: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in frame.columns else default


def current_budget(budget: DataFrame) -> DataFrame:
    """One amount per period type, period, section and category, from the active rows.

    Of each entry (those and its subcategory) the highest active version counts, rows that
    share it add up; entries then add up to their category.  ``period_type`` defaults to Monthly,
    ``version`` to 1.
    """
    kind = _or(budget, "period_type", F.lit("Monthly"))
    rows = budget.where("is_active").select(
        kind.alias("period_type"), _period_start(kind, F.col("period_start_date")).alias("period_start_date"),
        "cash_flow_section", "cash_flow_category",
        (F.col("cash_flow_subcategory") if "cash_flow_subcategory" in budget.columns else F.lit(None))
        .cast("string").alias("_entry"),
        _or(budget, "version", F.lit(1)).cast("bigint").alias("version"), units("budget_amount").alias("_units"))
    keys = ["period_type", "period_start_date", "cash_flow_section", "cash_flow_category"]
    versions = rows.groupBy(*keys, "_entry", "version").agg(F.sum("_units").alias("_units"))
    entries = versions.groupBy(*keys, "_entry").agg(F.max_by("_units", "version").alias("_units"),
                                                    F.max("version").alias("version"))
    return entries.groupBy(*keys).agg(F.max("version").alias("version"),
                                      from_units(F.sum("_units")).alias("budget_amount"))


def budget_variance(budget: DataFrame, ledger: DataFrame) -> DataFrame:
    """Budget against actuals by period type, period, section and category.

    Actual rows are summed by month once; a month then counts in its month, quarter and
    year.  Monthly rows appear for every category with budget or actuals, quarterly and annual
    ones where the active budget has that type at all.  Both sides are aggregated before the
    full outer join.
    """
    planned = current_budget(budget)
    keys = ["period_type", "period_start_date", "cash_flow_section", "cash_flow_category"]
    months = (ledger.where(~F.col("is_forecast"))
              .groupBy(month_start(F.col("cash_date")).alias("month"), *keys[2:])
              .agg(F.sum(units("amount")).alias("_units")))
    used = planned.agg(F.collect_set("period_type")).scalar()  # three names at most
    grains = months.withColumn("period_type", F.explode(F.array(*map(F.lit, PERIODS)))).where(
        (F.col("period_type") == "Monthly") | F.array_contains(used, F.col("period_type")))
    actual = grains.groupBy(
        "period_type", _period_start(F.col("period_type"), F.col("month")).alias("period_start_date"),
        *keys[2:]).agg(from_units(F.sum("_units")).alias("actual_amount"))
    zero = F.lit(0.0)
    joined = planned.join(actual, keys, "full")
    variance = from_units(units(F.coalesce("actual_amount", zero))
                          - units(F.coalesce("budget_amount", zero)))
    return (joined.withColumn("variance_amount", variance)
            .withColumn("variance_pct",
                        F.try_divide("variance_amount", F.abs("budget_amount")) * 100))
