"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from paddock.session import local_session
from registry.queries import QUERIES

HEADLINE = [
    "races_by_date",
    "participants_by_race",
    "daily_features",
    "training_set",
    "history_as_of",
    "engineered_features",
    "predict_race",
    "value_bets",
    "race_analysis_top3",
    "load_participants_once",
    "parse_participants",
    "load_program",
    "roc_auc",
    "ordinal_encode",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    # Each query is run once untimed, so that timings show execution, not code loading.
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
