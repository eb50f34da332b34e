"""Time the headline queries. Prints one JSON line.

Each query is built and run in full (all rows and columns go to a sink that discards
them) once to warm up and then ``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from txnrisk.plans.queries import REGISTRY  # noqa: E402
from txnrisk.session import configure  # noqa: E402

HEADLINE = [
    "score_landing",
    "clean_rows",
    "dup_profile",
    "null_profile",
    "label_vocab",
    "onehot_fixed",
    "onehot_named",
    "assemble_v36",
    "assemble_v40",
    "incr_newer_than",
    "incr_topn",
    "incr_topn_ties",
    "incr_left_anti",
    "incr_by_row_index",
    "ordered_index",
    "page_offset",
    "time_split",
    "hash_split",
    "json_encode",
    "json_decode",
    "score_pinned",
    "score_join_back",
    "metric_auc",
    "metrics_report",
    "src_csv_roundtrip",
    "load_incremental",
    "curate_full",
    "curate_incremental",
    "stream_ingest",
    "stream_score",
    "rf_train_score",
    "lr_train_score",
    "score_new",
    "score_saved_forest",
    "split_files",
    "page_offset_far",
    "time_split_nulls",
    "score_bucketed",
    "watermark_footer",
    "vocab_merge",
    "json_infer",
    "stream_score_dedup",
    "stream_from_keyset",
]


def session(cpus: str) -> SparkSession:
    base = tempfile.mkdtemp(prefix="bench-")
    spark = (
        configure(SparkSession.builder)
        .master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .config("spark.checkpoint.dir", f"{base}/shared")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(cpus)

    def once(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
