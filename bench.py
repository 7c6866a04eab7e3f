"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query's time is plan construction (including any small fitted aggregates) plus
a full execution into Spark's no-op sink. The interactions table is the first query;
later queries read it from the session's persisted copy, as the stage hand-over does.
``cold`` has the times after all persisted inputs were dropped (BENCH_COLD=0 skips them).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "interactions",
    "temporal_split",
    "validation_report",
    "features",
    "describe",
    "evaluate_full",
    "item_cosine",
    "evaluate_full_item_cf",
    "rec_svd",
    "rec_als",
    "mutual_information",
    "k_core_filter",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from recspark.plans.catalog import QUERIES
    from recspark.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="recspark-bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    keys = sys.argv[1:] or HEADLINE
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"{k}: {times[k]}s", file=sys.stderr)
    cold = {}
    if os.environ.get("BENCH_COLD", "1") != "0":
        from recspark.plans.catalog import release

        for k in keys:
            release()
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            cold[k] = round(time.perf_counter() - t0, 3)
            print(f"{k}: {cold[k]}s cold", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "cold": cold, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
