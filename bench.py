"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores.
Each query runs once untimed on the same tables, then once timed; results are fully computed.
"""

from __future__ import annotations

import json
import os
import time

from arealoom.checks import QUERIES
from arealoom.session import local_session

HEADLINE = [
    "pip7_reallocate_counts", "pip3_build_bridge", "pip4_build_area_bridge", "pip5_build_ratio_bridge",
    "pip6_dominant_category", "pip8_allocate_wide", "pip9_assemble_master", "pip11_activity_context",
    "pip14_select_sources", "agg3_ratio_allocation", "agg12_allocation_audit", "agg14_numeric_profile",
    "agg16_pivot_first", "agg19_select_measures", "win1_dominant", "win6_select_period", "win7_ffill",
    "win12_duplicate_groups", "jn9_fallback_join", "jn12_reconcile_paths", "jn15_discover_keys", "dat1_parse_period",
    "num1_parse_measure", "aud7_audit_bridge", "cls4_geography_from_values", "src9_extract_links",
    "src11_combine_headers",
]


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores=cpus, memory=os.environ.get("BENCH_MEMORY", "16g"), app="bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf)
        seconds[name] = round(run(spark, name, sf), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
