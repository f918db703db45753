"""Headline-query benchmark.

Runs the main jobs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.  Each query is executed in full
with the no-op sink (nothing is collected to the driver); the value is the
sum of the per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from incidex.plans.catalog import QUERIES  # noqa: E402
from incidex.session import build_session  # noqa: E402

HEADLINE = [
    "rate_index_sector",          # flagship: totals + per-type counts + population index
    "agg_total_and_pivot",
    "dedup_priority_rank",        # source-priority de-duplication
    "normalize_text",             # accent folding + cleaning over whole documents
    "spatial_join_points_zones",  # grid spatial join, 3 shapes x 2 point sets
    "dissolve_area",              # edge-cancellation dissolve + shoelace area
    "geojson_municipalities",     # read parts + dissolve by municipality + polygons + write
                                  # (the reference's dissolve micro-benchmark)
    "log_stage_metrics",          # distributed forward fill + conditional aggregates
    "bronze_table",
    "silver_incidents",           # union, dedup, keys, classification, spatial join
    "gold_sector_rates",
    "gold_municipality_rates",
    "etl_table_rows",             # the whole layered run: 20 tables written, read back, checked
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app_name="incidex-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra_conf={"spark.driver.memory": "16g"})
    # warm-up: JVM class loading and the parquet footer cache
    QUERIES["scan_parquet"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            print(f"{name} failed: {str(e)[:300]}", file=sys.stderr)
            times[name] = None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(t for t in times.values() if t is not None), 3)
    print(json.dumps({"metric": "headline_queries_total_wall", "value": total,
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
