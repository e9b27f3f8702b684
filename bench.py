"""Benchmark the headline analytics and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs end to end (driver tables -> adapters -> operator) into Spark's ``noop``
sink; the clock starts before the DataFrame is built, so work done while building counts.
A warm-up on sf0.001 absorbs JVM start and code generation; every query is then timed
three times and the fastest run is reported.  ``measures`` has, per query and for its
literal join / window formulation (``plans/literal.py``; BENCH_LITERAL=0 skips it), the
seconds, the shuffles, broadcasts and reused exchanges of the final plan and the shuffle
bytes of one run, from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from flowlens.plans import catalog  # noqa: E402
from flowlens.plans.inspect import final_plan, plan_counts, shuffle_bytes  # noqa: E402
from flowlens.plans.literal import LITERAL  # noqa: E402
from flowlens.session import local_session  # noqa: E402

HEADLINE = [
    "stage_responsible",              # V1
    "state_durations",                # V2 (line-item log: the largest input)
    "first_vs_repeat",                # V3
    "monthly_growth",                 # V4
    "daily_funnel",                   # V5
    "event_paths_reference_graph",    # V6, 17 edges
]
WARMUP_DIR = "/root/testdata/sf0.001"


def run(query, spark: SparkSession, sf_dir: str) -> float:
    t0 = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def measured(spark: SparkSession, sf_dir: str, name: str, query, times: int) -> dict:
    seconds = min(run(query, spark, sf_dir) for _ in range(times))
    counts = plan_counts(final_plan(query(spark, sf_dir)))
    spark.sparkContext.setJobGroup(name, name)
    run(query, spark, sf_dir)
    spark.sparkContext.setJobGroup("other", "other")
    return {"sec": round(seconds, 3)} | {k: counts[k] for k in ("shuffles", "broadcasts", "reused_exchanges", "scans")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus)))
    events = tempfile.mkdtemp(prefix="flowlens-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=partitions, app_name="flowlens-bench", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    queries = {k: catalog.queries()[k] for k in keys}
    literal = {k: LITERAL[k] for k in keys if k in LITERAL and os.environ.get("BENCH_LITERAL", "1") != "0"}
    for key in keys:
        run(queries[key], spark, WARMUP_DIR)
    measures = {k: {"flowlens": measured(spark, sf_dir, f"flowlens {k}", q, 3)} for k, q in queries.items()}
    for key, query in literal.items():
        run(query, spark, WARMUP_DIR)
        measures[key]["literal"] = measured(spark, sf_dir, f"literal {key}", query, 2)
    spark.stop()
    written = shuffle_bytes(events)
    for key, sides in measures.items():
        for side, found in sides.items():
            found["shuffle_bytes"] = written.get(f"{side} {key}", 0)
    times = {k: measures[k]["flowlens"]["sec"] for k in keys}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_views", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "measures": measures}))


if __name__ == "__main__":
    main()
