"""Literal formulation vs flowlens plan, both on Spark, same session.

    python tools/literal_baseline.py [sf_dir] [key ...]

For each key: wall time (best of 2, ``noop`` sink, clock started before the DataFrame is
built) and the node counts of both final plans.  Prints one JSON line per key.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowlens.plans import catalog  # noqa: E402
from flowlens.plans.inspect import final_plan, plan_counts  # noqa: E402
from flowlens.plans.literal import LITERAL  # noqa: E402
from flowlens.session import local_session  # noqa: E402


def timed(query, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=16)
    for key in sys.argv[2:] or LITERAL:
        ours, literal = catalog.queries()[key], LITERAL[key]
        print(json.dumps({
            "query": key, "sf_dir": sf_dir, "literal_sec": min(timed(literal, spark, sf_dir) for _ in range(2)),
            "flowlens_sec": min(timed(ours, spark, sf_dir) for _ in range(2)),
            "literal_plan": plan_counts(final_plan(literal(spark, sf_dir))),
            "flowlens_plan": plan_counts(final_plan(ours(spark, sf_dir)))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
