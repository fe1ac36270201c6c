"""Times the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. All
result columns are computed: the frame is written to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from rivulet.plans import QUERIES  # noqa: E402

HEADLINE = [
    "word_count",
    "running_sum",
    "running_distinct",
    "grouped_count",
    "custom_accumulator",
    "tumbling_count",
    "sliding_hop",
    "sliding_panes",
    "session_gap",
    "count_window_sliding",
    "unique_visitors_hourly",
    "unique_visitors_bitmap",
    "hot_items_topn",
    "hot_pages_topn",
    "ad_clicks_by_province_topn",
    "blacklist_pass",
    "late_status",
    "lateness_firings",
    "window_join",
    "interval_join",
    "reconcile_connect",
    "broadcast_control",
    "cep_next",
    "cep_followed_by",
    "cep_followed_by_any",
    "order_timeout",
    "order_timeout_cep",
    "login_fail_process",
    "rising_level_alarm",
    "retract_changelog",
    # Keys hot enough to be cut into chunks, and a stream.
    "running_text_order",
    "running_ties",
    "stream_tumbling_count",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rivulet-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
