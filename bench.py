"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores. Every query runs once to warm up and then
three times; the median counts. Results are written to the no-op sink, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from loadkeeper.plans.queries import QUERIES
from loadkeeper.session import builder

HEADLINE = (
    "stage_reconcile", "raw_worklist", "certified_worklist", "curated_worklist", "recon_worklist_saturday",
    "list_dependency_gate", "edges_complete", "window_rows", "two_column_window", "historical_union",
    "window_query_text", "watermark_advance", "batch_decision", "batch_rollup", "audit_fix", "row_change_audit",
    "run_summary", "success_detail", "failure_detail", "lineage", "notification_failed", "three_layer_recon",
    "refresh_plan_full", "refresh_payload", "dq_counts", "dq_duplicates", "upsert_rows", "camel_case",
    "dq_duplicate_rejects", "upsert_history", "notification_success", "stage_notification", "refresh_payload_quarter",
    "batch_close", "batch_close_rollup", "batch_open",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
             "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
