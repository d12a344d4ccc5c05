"""Time the headline queries and print one JSON line.

Fixture folders are written before the clock starts. Every query runs once to warm up
and then three times into a sink that discards rows; the best run counts. Streams
include writing to a fresh table.
"""

from __future__ import annotations

import json
import os
import sys
import time

from medallion.plans.landing import landing, users_table
from medallion.plans.queries import queries
from medallion.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "bronze_json_stream",
    "spend_csv_float",
    "silver_declarative",
    "gold_declarative",
    "gold_delete",
    "gold_as_of",
    "gold_merge",
    "compact_table",
    "top_postcodes",
    "table_profile",
    "frequent_values",
    "pair_regression",
    "density_bins",
    "density_curve",
    "latest_orders",
    "nearest_centre",
    "elbow_sweep",
    "segment_kmeans",
]


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark_sql_shuffle_partitions=CPUS, spark_driver_memory="7g")
    spark.sparkContext.setLogLevel("ERROR")
    landing(spark, SF_DIR)
    users_table(spark, SF_DIR)
    registered, seconds = queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):
            started = time.monotonic()
            registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.monotonic() - started)
        seconds[name] = round(min(runs[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
