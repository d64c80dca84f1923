"""Headline queries, seconds each (median of three after a warm-up); one JSON line.

``$BENCH_SF_DIR`` names the tables, ``$BENCH_CPUS`` the number of cores.
Streams run twice, the second run counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ebbline.plans.catalog import QUERIES  # noqa: E402

BATCH = [
    "tokens_drop_empty",
    "tokens_whitespace",
    "event_decode_filter",
    "window_count_5s",
    "sliding_count",
    "lifetime_count",
    "decay_final",
    "decay_final_long",
    "decay_running",
    "topk_ranked_list",
    "creator_affinity",
    "knn_candidates",
    "key_families",
    "feature_matrix",
    "viewed_not_purchased",
]
STREAMS = ["stream_word_windows", "stream_lifetime", "stream_counters", "stream_counter_slices", "stream_candidates"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ebbline-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in BATCH + STREAMS:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(3 if name in BATCH else 1)), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "stream_rows_per_sec": {n: round(events / seconds[n]) for n in STREAMS},
            }
        )
    )


if __name__ == "__main__":
    main()
