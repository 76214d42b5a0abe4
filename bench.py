"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores.  Each query runs once to warm up code paths and then
BENCH_RUNS times (default 3); the median counts.  Results go to a no-op sink,
so every column of every row is computed.

The session is the package's own, with the broadcast limit that users get.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tillflow.plans import registry
from tillflow.session import build_session

HEADLINE = [
    "revenue_by_channel", "refunds_by_platform", "cogs_and_fees", "vendor_payments",
    "purchase_commitments", "consolidated_cash_flow", "settle_deposits", "deposits_to_ledger",
    "invoices_to_ledger", "invoices_preview", "v_daily_cash_flow", "v_weekly_cash_flow",
    "v_cash_position", "weekly_balance", "dashboard_kpis", "scenario_comparison",
    "loan_status", "schedule_totals", "weekly_forecast", "cash_position_runway",
    "apply_payment_timing", "gl_to_ledger", "budget_variance", "payout_settlement",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="16g", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.load()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: first {times[0]:.2f}, then {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "cash_flow_queries_total_seconds",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).lstrip("sf")}))


if __name__ == "__main__":
    main()
