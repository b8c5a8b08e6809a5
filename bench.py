"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]. Each query's whole result is
computed, best of BENCH_RUNS runs (default 2) after three queries to warm up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from barloom.plans.catalog import QUERIES
from barloom.session import build_session

HEADLINE = [
    "stage_bars",
    "export_bars",
    "upsert_bars",
    "insert_if_absent",
    "upsert_daily_summary",
    "upsert_latest_price",
    "incremental_filter",
    "late_rows",
    "advance_watermark",
    "load_audit",
    "backfill_plan",
    "backfill_progress",
    "mart_daily_summary",
    "mart_latest_price",
    "mart_volume_rank",
    "bars_row_number",
    "price_changes",
    "recent_price_changes",
    "volume_leaders",
    "symbol_coverage",
    "serve_latest_price",
    "quality_checks",
    "quality_gate",
    "dq_unique",
    "dq_foreign_key",
    "dq_freshness",
    "step_metrics",
    "sla_report",
    "classify_failures",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    for name in ("symbol_coverage", "mart_volume_rank", "stage_bars"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
