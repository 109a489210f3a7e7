"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs of
each query after one warm-up, of which the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from stationday.session import configured  # noqa: E402

HEADLINE = (
    "wide_daily",
    "daily_summary_all",
    "hottest_all",
    "highest_precipitation_all",
    "all_conditions",
    "nearest_one",
    "nearest_all",
    "sql_daily_summary",
    "key_check",
    "source_times",
    "station_dimension",
    "nested_groups",
    "envelope_roundtrip",
    "pollen_values",
    "conditions",
    "hour24",
    "strict_cast",
    "payload_manifest",
    "geojson_roundtrip",
    "publish_roundtrip",
    "raw_csv_roundtrip",
    "raw_csv_split_roundtrip",
    "full_rebuild",
)
ONCE = {"publish_roundtrip", "raw_csv_roundtrip", "raw_csv_split_roundtrip", "full_rebuild"}  # these write files


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        configured(SparkSession.builder.master(f"local[{cpus}]").appName("stationday-bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(1 if name in ONCE else runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
