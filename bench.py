"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

    BENCH_QUERIES=all   time every registered query
    BENCH_QUERIES=a,b   time the named ones
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sync_orders_by_status",
    "sync_with_drift_repair",
    "src02_chunk_bounds",
    "src08_fixed_width",
    "src09_bai2_transactions",
    "src14_range_vector",
    "snk01_keyed_upsert",
    "snk01_versioned_merge",
    "snk05_resumable_state",
    "flt01_recursive_flatten",
    "exp02_ordered_children",
    "exp09_expand_entity",
    "inc03_compound_cursor",
    "inc10_per_entity_cursor",
    "inc12_content_hash",
    "chg01_apply_change_log",
    "chg04_shrunk_containers",
    "jn06_nest_top_children",
    "jn10_graph_triplets",
    "jn12_time_windows",
    "agg03_top_by_count",
    "agg14_interval_metrics",
    "agg14_status_revenue",
    "win01_global_row_ids",
    "win03_carry_forward",
    "win05_top_per_parent",
    "dq01_accept_reject",
    "dq04_count_reconciliation",
    "enr03_structured_answers",
    "stm05_hourly_counts",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from tidemark.queries.registry import load_all

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    registry["agg14_status_revenue"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
