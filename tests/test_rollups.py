"""Distinct counts that roll up, interval joins, the dense month spine."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import CONTRACTS_SCHEMA, EVENTS_SCHEMA, LEADS_SCHEMA, USERS_SCHEMA, money, ts
from pyspark.sql import functions as F

from flowlens.functions.distinct import dense_ids, distinct_bitmaps, roll_up
from flowlens.functions.intervals import day_interval_join
from flowlens.operators.funnel import active_users, sales_after_registration
from flowlens.operators.growth import monthly_growth


@pytest.mark.parametrize("at", [None, "t"])
def test_ids_are_dense_and_stable(spark, at):
    rng = random.Random(1)
    rows = [(rng.choice([None, *[f"u{j}" for j in range(300)]]), ts(f"2024-0{rng.randrange(1, 9)}-11")) for _ in range(2000)]
    got = dense_ids(spark.createDataFrame(rows, "k string, t timestamp_ntz").repartition(5), "k", at=at, slice_rows=20).collect()
    assert sorted(r.dense_id for r in got) == list(range(1, len({k for k, _ in rows if k}) + 1))
    if at:
        first = {}
        for k, t in rows:
            if k:
                first[k] = min(t, first.get(k, t))
        assert [r.k for r in sorted(got, key=lambda r: r.dense_id)] == sorted(first, key=lambda k: (first[k], k))


def test_bitmaps_count_across_blocks(spark):
    """Ids on both sides of the block size; a member of both days counts once."""
    ids = [1, 2, 32_768, 32_769, 65_536, 65_537, 10 ** 9]
    rows = [("d1", i, i % 2 == 0) for i in ids] + [("d2", i, True) for i in ids[3:]] + [("d2", 7, None), ("d2", None, True)]
    maps = distinct_bitmaps(spark.createDataFrame(rows * 2, "day string, id long, flag boolean"), ["day"], "id", {"all": F.lit(True), "flagged": "flag"})
    assert [(r["all"], r.flagged) for r in roll_up(maps, [], ["all", "flagged"]).collect()] == [(8, 6)]
    assert {r.day: (r["all"], r.flagged) for r in roll_up(maps, ["day"], ["all", "flagged"]).collect()} == {"d1": (7, 4), "d2": (5, 4)}


def test_active_users_equal_direct_counts(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "hot", "hot", *[f"u{j}" for j in range(60)]]), None if i % 50 == 0 else
             ts(f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d} 10:00:00"), rng.choice("ab"), "ios") for i in range(1500)]
    got = {(r.grain, r.period, r.event_name): r.users for r in active_users(spark.createDataFrame(rows, EVENTS_SCHEMA)).collect()}
    want = {}
    for _, user, at, name, _ in rows:
        if user and at:
            day = at.replace(hour=0)
            for grain, start in (("day", day), ("week", day - dt.timedelta(days=day.weekday())), ("month", day.replace(day=1))):
                want.setdefault((grain, start, name), set()).add(user)
    assert got == {k: len(v) for k, v in want.items()}


def test_interval_join_equals_pairs(spark):
    rng = random.Random(3)

    def day():
        return None if rng.random() < 0.05 else ts("1969-12-20") + dt.timedelta(days=rng.randrange(120), hours=rng.randrange(24))
    keys = [None, "a", "b", "hot", "hot", "hot"]
    left = [(rng.choice(keys), day(), i) for i in range(150)]
    right = [(rng.choice(keys), day(), i) for i in range(300)]
    dfs = (spark.createDataFrame(left, "k string, s timestamp_ntz, l int"), spark.createDataFrame(right, "k string, at timestamp_ntz, r int"))
    for days in (0, 1, 30):
        got = sorted((r.l, r.r, r.days_after) for r in day_interval_join(*dfs, ["k"], "s", "at", days).collect())
        want = sorted((x[2], y[2], (y[1].date() - x[1].date()).days) for x in left for y in right if x[0] and x[0] == y[0] and x[1] and y[1]
                      and 0 <= (y[1].date() - x[1].date()).days <= days)
        assert got == want and len(want) > 10


def test_a_hot_user_is_spread_over_the_bins(spark):
    """All registrations and sales of one user: the join's tasks get a bin's share each."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("32", "false", "-1"), strict=True):
        spark.conf.set(k, v)
    try:
        days = spark.range(3000).select(F.lit("hot").alias("user_id"), F.col("id"))
        users = days.select("user_id", (F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("created_at"))
        sales = days.select(F.col("id").alias("followup_id"), "user_id", (F.lit("2000-01-01 09:00:00").cast("timestamp_ntz")
                            + F.make_dt_interval(days=F.col("id").cast("int"))).alias("created_at"), F.lit("x").alias("status"))
        out = sales_after_registration(users, sales)
        tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 3000 * 31 - 30 * 31 // 2 and max(tasks) < sum(tasks) / 5
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dense_months_carry_cumulative_columns(spark):
    users = spark.createDataFrame([("u1", "A", ts("2023-01-05"), False, None), ("u2", "B", ts("2023-04-05"), False, None)], USERS_SCHEMA)
    leads = spark.createDataFrame([("u1", "L1", "SIAPE", 0, True, True, False, False, "1", ts("2023-01-06"), 1)], LEADS_SCHEMA)
    contracts = spark.createDataFrame([("c1", ts("2022-12-05"), money(10)), ("c1", ts("2023-03-05"), money(5)), ("c2", ts("2023-05-05"), money(7))], CONTRACTS_SCHEMA)
    got = {r.month: r for r in monthly_growth(users, leads, contracts, since=None, dense=True).collect()}
    assert sorted(got) == [ts(f"{y}-{m:02d}-01") for y, m in ((2022, 12), (2023, 1), (2023, 2), (2023, 3), (2023, 4), (2023, 5))]
    feb, may = got[ts("2023-02-01")], got[ts("2023-05-01")]
    assert (feb["Total Covenants"], feb["User Base"], feb["Qualified Users"], feb["Total Clients"], feb["Clients This Month"]) == (1, 1, 1, 1, None)
    assert (may["Total Covenants"], may["User Base"], may["Qualified Users"], may["Total Clients"], may["New Clients"]) == (2, 2, 1, 2, 1)
    assert got[ts("2022-12-01")]["User Base"] is None and got[ts("2023-03-01")]["Commission This Month"] == 5.0
    assert sorted(r.month for r in monthly_growth(users, leads, contracts, since="2023-04-01", dense=True).collect()) == [ts("2023-04-01"), ts("2023-05-01")]
    assert [r.month for r in monthly_growth(users, leads, contracts, since=None).collect() if r.month] == [ts("2023-01-01")]
    none = [df.limit(0) for df in (users, leads, contracts)]
    assert monthly_growth(*none, dense=True).collect() == []
