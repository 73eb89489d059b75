"""Benchmark the headline queries.

Runs each query's full plan (noop sink: every row produced, nothing collected)
at $BENCH_SF_DIR on local[$BENCH_CPUS]; each query runs once cold and
$BENCH_WARM_RUNS (default 2) times warm; the best warm run is reported, all runs
are kept in the JSON ("cold", "warm_runs").  Prints ONE JSON line.
$BENCH_EVENT_LOG (optional): folder for Spark's event log (stage and task times).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickfeat.plans.registry import QUERIES, load_all  # noqa: E402
from clickfeat.session import get_session, release_materialized  # noqa: E402

HEADLINE = [
    "all_counters", "all_counters_union", "training_vectors", "cosine_top5", "query_rewrites",
    "weighted_draws", "positive_draws", "negative_rows", "feature_store", "lr_weights", "gbt_error",
]


WARM_RUNS = int(os.environ.get("BENCH_WARM_RUNS", "2"))


def run(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    load_all()
    mem = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    extra = {"spark.driver.memory": mem}
    if os.environ.get("BENCH_EVENT_LOG"):          # stage/task times: Spark event log in a scratch folder
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(f"local[{cpus}]", app="clickfeat-bench", shuffle_partitions=max(cpus, 8), extra=extra)
    warm, cold, runs = {}, {}, {}
    for n in names:
        cold[n] = round(run(spark, n, sf_dir), 3)
        runs[n] = [round(run(spark, n, sf_dir), 3) for _ in range(WARM_RUNS)]
        warm[n] = min(runs[n])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_warm", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold": cold, "warm_runs": runs, "sf": sf, "cpus": cpus,
                      "driver_memory": mem, "spark": spark.version}))
    release_materialized()
    spark.stop()


if __name__ == "__main__":
    main()
