"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to completion into a sink that throws the rows away: once to warm
up, then ``BENCH_RUNS`` times, of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from veritally.session import local_session
from veritally.verification.registry import QUERIES

HEADLINE = (
    "score_rollouts",
    "evaluate_split",
    "compare_models",
    "compare_models_whole_split",
    "extract_prediction",
    "group_advantage",
    "accuracy",
    "running_reward",
    "seeded_shuffle",
    "vocab_encode",
    "policy_loss",
    "policy_loss_from_arrays",
    "training_metrics",
    "training_metrics_from_arrays",
    "prepare_examples",
    "log_softmax",
    "streaming_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken[1:]), 3)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count(F.lit(1))).first()[0] * 4
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "rollouts": rows,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
