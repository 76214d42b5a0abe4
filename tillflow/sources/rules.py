"""Rule tables from configuration: category map and payment timing.

Configuration is written by hand and has at most a few hundred entries, so it
is read on the driver and becomes a small local relation.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CATEGORY_SCHEMA = ("section string, account string, account_number string, category string, "
                   "subcategory string, cash_timing string, is_cash boolean, position int")

RULE_SCHEMA = ("term_id string, term_category string, cycle_type string, lag_days bigint, "
               "settlement_period_days bigint, settlement_lag_days bigint, "
               "payout_days array<string>, weekend_handling string")

NON_CASH = "non_cash_items"
# Accounts that only reconcile to deposits booked elsewhere; no cash of their own.
CLEARING = "clearing_accounts"


def load_yaml(path: str | Path) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML configuration needs the yaml package") from error
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def category_map(spark: SparkSession, config: Mapping[str, list[Mapping[str, Any]]]) -> DataFrame:
    """Rows (section, account, number, category, ...) of a category configuration."""
    rows = []
    for section, entries in config.items():
        for entry in entries:
            number = entry.get("account_number")
            rows.append((section, entry["account"], None if number is None else str(number),
                         entry.get("category"), entry.get("subcategory"),
                         entry.get("cash_timing"), section not in (NON_CASH, CLEARING), len(rows)))
    return spark.createDataFrame(rows, CATEGORY_SCHEMA)


def _rule(term_id: str, group: str, rule: Mapping[str, Any]) -> tuple:
    period = rule.get("settlement_period_days")
    days = next((rule[k] for k in ("payout_lag_days", "typical_payment_days",
                                   "actual_payment_days", "payment_delay_days")
                 if rule.get(k) is not None), None)
    if days is None and rule.get("payment_timing") == "immediate":
        days = 0
    listed = [*(rule.get("payout_days") or []), *(rule.get("payment_days") or [])]
    if rule.get("payment_day") is not None:
        listed.append(rule["payment_day"])
    payout_days = [str(d) for d in listed] or None
    weekend = {"next_business_day": "Next Business Day",
               "previous_business_day": "Previous Business Day"}.get(
                   rule.get("weekend_handling", ""), "No Adjustment")
    return (term_id, group, rule.get("cycle"), None if period else days, period,
            days if period else None, payout_days, weekend)


# A lag that the configuration leaves open stays NULL: "with_settlement" and
# "with_payout" amounts never move cash of their own.
def timing_rules(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """Payment rules of the revenue and expense sections of a timing configuration."""
    groups = {"revenue_timing": "Revenue", "expense_timing": "Expense"}
    rows = [_rule(term_id, groups[section], rule)
            for section in groups for term_id, rule in config.get(section, {}).items()]
    return spark.createDataFrame(rows, RULE_SCHEMA)
