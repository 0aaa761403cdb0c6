"""Time the headline queries (best of BENCH_REPEAT runs) and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from orderweir import build_session
from orderweir.plans.registry import QUERIES

HEADLINE = [
    "fact_sales_order", "fact_rollup", "gold_summary", "gold_summary_chart", "line_item_rollup",
    "src_raw_orders", "proj_line_item", "unwrap_payload",
    "customer_sales_running", "customer_sales_latest", "latest_per_key", "dup_keys",
    "merge_sales_order", "merge_line_item", "upsert_customer360",
    "cdc_curated", "cdc_dedupe", "cdc_current_state", "cdc_scd2", "stream_customer_totals",
    "dq_not_null", "dq_rel_product", "order_total_reconcile", "layer_parity",
    "metric_gross_revenue", "freshness_p95", "alert_max_over_time", "alert_increase", "probe_health",
]


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="orderweir-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(spark, "line_item_rollup", folder)  # start-up cost is not part of any query
    seconds = {
        name: round(min(run(spark, name, folder) for _ in range(repeat)), 3) for name in names
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
