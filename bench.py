"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores. Each query is run once to warm up
and then ``BENCH_RUNS`` times (once if the first run took over three seconds); the median is reported. The
whole result is computed and thrown away.
``python bench.py name …`` times other queries, ``python bench.py all`` every one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tallyloom.plans import QUERIES

HEADLINE = [
    "group_size",
    "group_two_keys",
    "pivot_counts",
    "value_counts",
    "describe_numeric",
    "histogram",
    "latest_per_key",
    "top_subject_per_year",
    "net_balance",
    "join_inner",
    "join_outer_fill",
    "join_anti",
    "set_symdiff",
    "triples_labels",
    "enumerate_rows",
    "running_sum",
    "consecutive_groups",
    "top_k",
    "fill_median",
    "prime_filter",
    "parquet_roundtrip",
    "csv_roundtrip",
    "total_tokens",
    "word_freq_top",
    "text_normalise",
    "log_parse",
    "div_count",
    "html_stats",
    "mat_mul",
    "rgb_histogram",
    "image_stats",
    "segment_pixels",
    "classification_report",
    "linreg_poly",
    "kmeans",
    "elbow",
    "silhouette_exact",
    "dbscan",
    "random_forest",
    "user_profile",
    "als_topn",
    "stream_word_count",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        def once() -> float:
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - begun

        first = once()
        taken = [once() for _ in range(min(runs, 1) if first > 3 else runs)]
        seconds[name] = round(statistics.median(taken or [first]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
