"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and materialises the whole result through the
``noop`` sink (every row computed, nothing collected).  Prints one JSON
line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_accidents",
    "d2_parse_datetime_columns",
    "m8_imperial_to_metric",
    "a1_missing_share",
    "a5_describe_numeric",
    "a6_describe_strings",
    "n2_median_impute",
    "e1_one_hot_all",
    "x1_split_exact",
    "z1_standard_scale",
    "v2_v4_regression_metrics",
    "price_regression",
    "duration_regression",
    "g2_gini_tree",
    "n3_tree_impute",
    "k1_silhouette",
    "k2_calinski_harabasz",
    "cluster_sample",
    "c1_kmeans",
    "c2_gaussian_mixture",
    "c3_dbscan",
    "c4_birch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from tabloom.plans.registry import QUERIES, load_all
    from tabloom.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="tabloom-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    load_all()
    # warm-up outside the timing: JVM, parquet footers, Python workers
    QUERIES["m3_fahrenheit_to_celsius"](spark, sf_dir).write.format("noop").mode(
        "overwrite").save()
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
