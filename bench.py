"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and then ``$BENCH_RUNS`` times; the fastest run counts. Results are
computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_orders",
    "mart_monthly_sales",
    "customer_rfm",
    "production_demand_gap",
    "demand_features",
    "churn_features",
    "stockout_base",
    "stockout_features",
    "churn_split",
    "stockout_time_split",
    "metric_auc",
    "dq_report",
    "constraint_fk_violations",
    "ingest_surrogate_keys",
    "predictions_demand",
]


def main() -> None:
    from quayside.registry import QUERIES
    from quayside.session import get_spark

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(min(timed[1:]), 3)
    spark.stop()
    result = {
        "metric": "total_headline_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
