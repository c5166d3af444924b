"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma list of queries, or `all`
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rowwarden.plans import catalog  # noqa: E402
from rowwarden.session import build_session  # noqa: E402

HEADLINE = [
    "scan_project_filter", "bucket_scan", "parse_permissive", "lookup_enrich", "lookup_composite", "schema_conformance",
    "schema_evolution", "ruleset_first_match", "ruleset_all_failures", "route_three_way", "hash_canonical",
    "segment_digest", "segment_drilldown", "reconcile_full_outer", "reconcile_rules_v1", "hash_on_one_site",
    "interval_left_10s", "interval_full_10m", "stats_compare", "count_by_status", "tumbling_tagged_metrics",
    "window_stats", "word_count", "duplicate_flag", "zscore_running", "ewma_anomaly", "advanced_quality_flow",
    "upsert_latest", "upsert_ignore_nulls", "cdc_materialize", "snapshot_audit", "latest_n_per_day",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            # every output column of every row is made, nothing is kept
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
