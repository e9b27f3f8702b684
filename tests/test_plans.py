"""Plan shape: no nested-loop join, filters reach the scan, pruned reads."""

import pytest

from flowlens.plans import catalog
from flowlens.plans.inspect import physical_plan

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_no_nested_loop_or_cartesian(spark, key):
    plan = physical_plan(catalog.queries()[key](spark, SF))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_path_filter_pushed_to_scan(spark):
    plan = physical_plan(catalog.queries()["event_paths"](spark, SF))
    scans = [block for block in plan.split("\n\n") if "events.parquet" in block]
    assert len(scans) == 1, "events must be scanned once"
    assert "PushedFilters: [In(event_type" in scans[0]
    assert "props" not in scans[0] and "event_id" not in scans[0]


def test_responsible_scan_reads_only_needed_columns(spark):
    plan = physical_plan(catalog.queries()["stage_responsible"](spark, SF))
    assert "props" not in plan


def _scans_of(plan: str, table: str) -> int:
    return sum(1 for block in plan.split("\n\n") if f"{table}.parquet" in block and "Scan parquet" in block)


def test_durations_read_the_log_twice_and_start_no_job(spark):
    """Once for the bounds and splitters of a sale, once for its instants; nothing runs at definition."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("definition", "definition")
    query = catalog.queries()["state_durations"](spark, SF)
    spark.sparkContext.setJobGroup("other", "other")
    listing = 8   # one schema job per Parquet reader at most
    assert len(tracker.getJobIdsForGroup("definition")) <= listing
    assert _scans_of(physical_plan(query), "lineitem") == 2


def test_funnel_has_no_expand(spark):
    plan = physical_plan(catalog.queries()["daily_funnel"](spark, SF))
    assert "Expand" not in plan and "NestedLoopJoin" not in plan
