"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs once to warm up and then
BENCH_RUNS times, of which the best counts; its rows go to Spark's noop sink, so all columns of all
rows are computed and none travels to the driver.
"""

from __future__ import annotations

import json
import os
import time

from catalog import QUERIES
from prospectra.session import local_session

HEADLINE = [
    "prepare_dataset",
    "agg_usage_derived",
    "join_usage_left",
    "join_orphan_anti",
    "join_predictions_back",
    "dedup_most_complete",
    "dedup_first",
    "dup_groups",
    "top_prospects",
    "range_ordinal",
    "request_validate",
    "dq_schema",
    "dq_unique_soft",
    "dq_actions_ge_users",
    "profile_missing",
    "profile_duplicate_rows",
    "profile_numeric",
    "impute_auto",
    "encode_categorical",
    "scale_standard",
    "scale_robust",
    "feature_stages",
    "feature_stages_all_inputs",
    "split_stratified",
    "classification_report",
    "roc_auc",
    "pr_curve",
    "optimal_threshold",
    "score_histogram",
    "business_metrics",
    "cross_validate",
    "predict",
    "score_requests",
    "score_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    seconds, first = {}, {}
    for name in names:
        times = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        first[name], seconds[name] = round(times[0], 3), round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
