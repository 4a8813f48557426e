"""Time the headline queries: one JSON line, seconds per query (the better of two runs)."""

from __future__ import annotations

import json
import os
import time

import suite
from pagecat.session import build
from suite.base import QUERIES

HEADLINE = (
    "first_links_by_host", "h1_extract_links", "h13_parse_size_mb", "a1_largest_variant",
    "a3_pivot_last_wins", "a6_collect_variants", "w1_dedup_first_seen", "w5_last_write_per_key",
    "s5_upsert", "m1_publish_catalog", "m1_publish_variants", "m8_overwrite_variants",
    "j5_cooldown_join", "j6_cached_result_join", "m9_classify_requests", "m10_admit_runs",
    "t2_cooldown_gate", "t3_single_flight", "t6_status_transitions", "g1_paginate",
    "g3_resolve_redirects", "m2_discover", "m3_extract_catalog", "m4_extract_variants", "m5_item_outcome",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    suite.load_all()
    spark = build(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or list(HEADLINE)
    times = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
