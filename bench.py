"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Start-up is excluded; each query runs once to warm up and then the median of two runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ledgerloom.session import build_session
from verification.registry import QUERIES

HEADLINE = [
    "monthly_spend_trend", "dept_budget_performance", "manager_workload", "vendor_concentration",
    "open_financial_issues", "largest_increases", "above_avg_pending", "projects_clean",
    "employees_clean", "employee_detection_report", "transactions_enriched",
    "dim_employee_scd2", "fact_transactions", "bridge_employee_project", "as_of_join",
    "as_of_join_merge", "dq_report", "events_clean", "project_activity_summary",
    "user_activity_summary", "escalation_log", "daily_event_volume", "peak_usage_analysis",
    "numeric_summary", "stream_event_counts", "stream_critical_route", "event_job", "foundations_job",
    "star_reconciliation",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(RUNS + 1):
            started = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - started)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
