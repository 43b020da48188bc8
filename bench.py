"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query runs to completion into Spark's ``noop`` sink (the whole plan executes, nothing
is collected): one warm-up, then the median of $BENCH_REPEAT runs (default 3).
The metric is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from satlink.plans.catalog import queries  # noqa: E402
from satlink.session import local_session  # noqa: E402

# scan, flatten, first load, second load (append / upsert), PIT, mart, and the rest of the
# operators that do real work over whole tables.
HEADLINE = [
    "scan_json_roundtrip",
    "stg_wikimedia",
    "stg_openaq",
    "hub_location",
    "link_project_article",
    "sat_append_article_views",
    "sat_upsert_sensor",
    "not_in_null_aware",
    "pit_article_day",
    "pit_latest_version",
    "pit_as_of",
    "mart_article_traffic_daily",
    "mart_population_by_country_year",
    "dq_relationships",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    qs = queries()
    out: dict[str, float] = {}
    for name in names:
        warm = run_once(spark, qs[name], sf_dir)
        runs = [run_once(spark, qs[name], sf_dir) for _ in range(repeat)]
        print(f"{name}: warm-up {warm:.2f}s, runs {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
        out[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": int(cpus), "repeat": repeat}))


if __name__ == "__main__":
    main()
