"""Times the catalogue's queries: cold (first run) and warm, whole results, one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens.plans.catalog import queries  # noqa: E402
from fleetlens.session import local_session  # noqa: E402

HEADLINE = [
    "state_hours", "weekly_state_fact", "wafer_production", "part_replacements", "daily_production", "weekly_production",
    "incremental_production", "production_audit", "config_mart", "drilldown", "leadership", "part_tool_counts_shared",
    "bucket_consistency", "inventory_by_part", "dedup_keep_last", "upsert", "key_overlap", "acceptance_checks",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, memory="16g", shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    catalog = queries()
    cold, warm = {}, {}
    for name in names:
        for times, rounds in ((cold, 1), (warm, 2)):
            best = None
            for _ in range(rounds):
                start = time.perf_counter()
                catalog[name](spark, directory).write.format("noop").mode("overwrite").save()
                seconds = time.perf_counter() - start
                best = seconds if best is None else min(best, seconds)
            times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "sum of best warm times of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
