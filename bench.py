"""Benchmark: headline catalogue entries over the generated tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma list, default the headline set).
Each entry is computed in full into Spark's ``noop`` sink (no collect to
the driver); the time is the median of the runs after one warm-up.
With BENCH_PIPELINE=1 (default) the physical batch path is timed once as
well (``pipeline_*``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.catalog import queries  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = [
    "revenue_by_category",
    "fact_order_items",
    "dedupe_latest",
    "scd2_product",
    "agg_daily_sales",
    "agg_customer_ltv",
    "incremental_aggregates",
    "dim_customer",
    "geo_centroid",
    "upsert_orders",
    "fact_payments",
    "fact_reviews",
    "route_children",
    "dq_log",
]


def pipeline_times(spark, sf_dir: str) -> dict[str, float]:
    """The physical path, timed once: cut the tables into monthly CSV
    batches, then load the first month (all reference data), an ordinary
    month and the product change month through bronze, silver and gold."""
    from strata.plans.run import run_batch
    from strata.session import shared_dir
    from strata.sources import testdata as td
    from strata.sources.lake import Lake

    root = shared_dir(spark, "strata-bench", f"pipeline-{int(time.time() * 1000)}")
    out = {}
    t0 = time.perf_counter()
    months = td.write_test_batches(spark, sf_dir, f"{root}/batches")
    out["pipeline_prepare_batches"] = round(time.perf_counter() - t0, 3)
    lake = Lake(spark, f"{root}/lake", buckets=16)
    for label, batch in [("first", months[0]), ("month", months[1]), ("change", td.CHANGE_BATCH)]:
        t0 = time.perf_counter()
        run_batch(lake, f"{root}/batches", batch)
        out[f"pipeline_{label}_batch"] = round(time.perf_counter() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="strata-bench")
    catalogue = queries()
    times: dict[str, float] = {}
    for name in names:
        fn = catalogue[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    if os.environ.get("BENCH_PIPELINE", "1") == "1":
        times.update(pipeline_times(spark, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_median_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
