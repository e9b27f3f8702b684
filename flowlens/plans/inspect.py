"""Plan inspection helpers used by tests and the bench."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The formatted physical plan (what ``df.explain('formatted')`` prints)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def final_plan(df: DataFrame) -> str:
    """Run the query and return the plan adaptive execution ended with."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def plan_counts(plan: str) -> dict[str, int]:
    """Nodes of a plan; shuffles, broadcasts and reused exchanges apart."""
    reused = plan.count("ReusedExchange")
    broadcasts = plan.count("BroadcastExchange")
    return {
        "shuffles": sum(line.lstrip(" :+-*()0123456789").startswith("Exchange ") for line in plan.splitlines()),
        "broadcasts": broadcasts,
        "reused_exchanges": reused,
        "scans": plan.count("Scan parquet") or plan.count("FileScan parquet"),
        "windows": sum(line.lstrip(" :+-*()0123456789").startswith("Window ") for line in plan.splitlines()),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "nested_loop_joins": plan.count("NestedLoopJoin"),
    }


def shuffle_bytes(log_folder: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the event logs in a folder."""
    group_of: dict[int, str] = {}
    total: dict[str, int] = {}
    for path in Path(log_folder).iterdir():
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id", "")
                group_of |= {s: group for s in event["Stage IDs"]}
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                group = group_of.get(event["Stage ID"], "")
                total[group] = total.get(group, 0) + event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    return total
