"""Benchmark: time the headline queries on one data folder.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Prints one JSON line:
{"metric": "total_query_time", "value": sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    # relational core
    "customer_features", "describe_features", "box_stats", "histogram_fd", "corr_pairs",
    "team_table", "category_domains", "row_ids",
    # windows and monitoring
    "event_batches", "latest_event_per_user", "predictions_with_truth", "batch_accuracy",
    # evaluation
    "classification_report", "roc_curve", "auc",
    # vectors and pages
    "knn_top3", "most_similar", "knn_classifier", "extract_links", "resolve_links",
    # models and explanations
    "churn_scores", "churn_explanations", "smote_oversample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from flurry.session import get_session
    spark = get_session(f"local[{cpus}]", app="flurry-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    from flurry.plans.registry import QUERIES

    only = [q for q in sys.argv[1:] if q in QUERIES] or HEADLINE
    # warm-up (untimed): JVM JIT, codegen, Python workers, parquet footers --
    # one scan, one join + aggregate, one Arrow pass
    spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).write.format("noop").mode("overwrite").save()
    QUERIES["customer_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["row_ids"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
