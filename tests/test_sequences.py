"""Ordered paths: first event strictly after the step before, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import EVENTS_SCHEMA, USERS_SCHEMA, ts
from pyspark.sql import functions as F

from flowlens.operators.sequences import ordered_paths, ordered_steps
from flowlens.plans import catalog

PATHS = {"abc": [["a"], ["b"], ["c"]], "aba": [["a"], ["b"], ["a"]], "any": [["a", "b"], ["a", "b"], ["c", "d"], ["a"]], "one": [["d"]]}


def plain_steps(rows, paths):
    """(user, path) -> times, by walking each user's events."""
    out = {}
    users = {r[1] for r in rows if r[1] is not None}
    for user in users:
        own = sorted((r[2], r[3]) for r in rows if r[1] == user and r[2] is not None)
        for name, steps in paths.items():
            times = []
            for step in steps:
                later = [at for at, kind in own if kind in step and (not times or at > times[-1])]
                if not later:
                    break
                times.append(min(later))
            if times:
                out[user, name] = times
    return out


def random_events(seed, n):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.4 else rng.choice([None, *[f"u{j}" for j in range(25)]]),
             None if rng.random() < 0.03 else ts(f"2024-01-01 10:{rng.randrange(60):02d}:{rng.randrange(0, 60, 6):02d}"),
             rng.choice("abcde"), "ios") for i in range(n)]


@pytest.mark.parametrize("slice_rows", [1, 4, 10 ** 9])
def test_steps_equal_brute_force(spark, slice_rows):
    for seed, n in ((1, 400), (2, 40)):
        rows = random_events(seed, n)
        df = spark.createDataFrame(rows, EVENTS_SCHEMA).repartition(3)
        got = {(r.user_id, r.path): r.times for r in ordered_steps(df, PATHS, slice_rows=slice_rows).collect()}
        assert got == plain_steps(rows, PATHS)


def test_equal_times_and_early_touches(spark):
    rows = [(1, "x", ts("2024-01-01 09:00:00"), "b", "ios"),       # early: another b comes later
            (2, "x", ts("2024-01-01 10:00:00"), "a", "ios"),
            (3, "x", ts("2024-01-01 10:00:00"), "b", "ios"),       # not later than a
            (4, "x", ts("2024-01-01 11:00:00"), "b", "ios"),
            (5, "x", ts("2024-01-01 11:00:00.5"), "c", "ios"),
            (6, "y", ts("2024-01-01 10:00:00"), "a", "ios"), (7, "y", ts("2024-01-01 10:00:00"), "b", "ios"),
            (8, "z", ts("2024-01-01 10:00:00"), "a", "ios")]
    events = spark.createDataFrame(rows * 3, EVENTS_SCHEMA)       # copies change nothing
    users = spark.createDataFrame([(u, "C", ts("2024-01-01"), False, None) for u in ("x", "x", "y")], USERS_SCHEMA)
    got = sorted((tuple(r) for r in ordered_paths(events, users, {"abc": PATHS["abc"]}).collect()), key=lambda r: r[1])
    assert got == [("abc", 1, None, "a", 2, None), ("abc", 2, "a", "b", 1, 3600), ("abc", 3, "b", "c", 1, 0)]


def test_no_events(spark):
    events = spark.createDataFrame([], EVENTS_SCHEMA)
    assert ordered_steps(events, PATHS).collect() == []


def test_plan_has_one_filtered_scan_and_no_chain_of_joins(spark):
    plan = catalog.q_ordered_steps(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("In(event_type") + plan.count("event_type#") >= 1


def test_walks_reach_every_edge_and_state(spark):
    """Both graphs show all 17 edges, all 37 ways have users and all 29 states are touched."""
    sf = "/root/testdata/sf0.01"
    for query in (catalog.q_event_paths_walks, catalog.q_event_paths_walks_literal):
        assert sorted(r.step_order for r in query(spark, sf).collect()) == list(range(1, 18))
    assert len({r.state for r in catalog.q_event_states_walks(spark, sf).select("state").distinct().collect()}) == 29
    assert catalog.q_path_ways(spark, sf).where(F.col("users") > 0).count() == 37


def test_a_hot_user_equals_brute_force(spark):
    """One user with a third of the driver's events."""
    from flowlens.sources import adapters as A
    events = A.app_events(spark, "/root/testdata/sf0.01").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id")))
    got = Counter((r.path, len(r.times)) for r in ordered_steps(events, catalog.ORDERED_PATHS, slice_rows=100).collect())
    rows = [(r.event_id, r.user_id, r.event_at, r.event_name) for r in events.collect()]
    assert got == Counter((path, len(times)) for (_, path), times in plain_steps(rows, catalog.ORDERED_PATHS).items())
