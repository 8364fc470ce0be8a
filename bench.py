"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores. Every query is
planned and run to its last row, without collecting it, ``BENCH_RUNS`` times; the best run counts and
the median is given beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "dim_aircraft_profile",
    "dim_aircraft_profile_join",
    "silver_conform",
    "silver_dedupe",
    "key_profile",
    "dim_airport",
    "airport_roles",
    "dim_aircraft_static",
    "home_airport",
    "dim_passenger_initial",
    "dim_passenger_increment",
    "passenger_upsert",
    "aircraft_scd2",
    "gold_cost_by_class",
    "gold_top_cost",
    "nth_row",
    "nth_row_deep",
    "nth_row_per_group",
    "not_null_violations",
    "file_stats",
    "json_props",
    "csv_roundtrip",
    "append_idempotent",
    "lake_aircraft",
    "lake_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lakeloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds, medians = {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
        medians[name] = round(statistics.median(times), 3)
        print(f"{name}: {' '.join(f'{t:.2f}' for t in times)}", file=sys.stderr, flush=True)
    spark.stop()

    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "medians": medians,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
