"""Ranks, running sums, last known values and percentiles against windows and plain Python."""

from __future__ import annotations

import random

import pytest
from conftest import FOLLOWUPS_SCHEMA, LEADS_SCHEMA, LOGS_SCHEMA, USERS_SCHEMA, followup, money, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.functions.carry import carry, quantiles, ranked
from flowlens.functions.semantics import newest_per_key, unique_or_fail
from flowlens.operators.durations import sla_summary, state_periods
from flowlens.operators.funnel import newest_leads
from flowlens.operators.growth import cumulative_commission
from flowlens.operators.purchases import purchase_numbers
from flowlens.operators.transitions import responsible_as_of
from flowlens.sources import adapters as A

SF = "/root/testdata/sf0.01"
ROWS = "k string, t timestamp_ntz, id long, v decimal(18,2), w string"


def random_rows(seed, n, hot=0.4):
    """One key with many rows, a NULL key, NULL times and values, times far apart and equal."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None, "", *[f"k{j}" for j in range(20)]])
        at = None if rng.random() < 0.05 else ts(f"{rng.choice([1969, 2024, 2024, 9999])}-0{rng.randrange(1, 9)}-1{rng.randrange(10)} 10:00:0{rng.randrange(10)}")
        rows.append((key, at, i, None if rng.random() < 0.3 else money(rng.randrange(-500, 500)), None if rng.random() < 0.6 else f"w{i}"))
    return rows


@pytest.mark.parametrize("slice_rows", [1, 7, 10 ** 9])
@pytest.mark.parametrize("period", [False, True])
def test_carry_equals_windows(spark, slice_rows, period):
    df = spark.createDataFrame(random_rows(3, 700), ROWS).repartition(4)
    day = F.to_date("t") if period else None
    for keys in (["k"], []):
        got = carry(df, keys, ["t", "id"], rank="n", sums={"s": "v", "c": F.lit(1)}, known={"last_w": "w", "last_v": F.col("v")},
                    period=day, slice_rows=slice_rows)
        w = Window.partitionBy(*keys).orderBy(F.col("t").asc_nulls_last(), "id")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = df.select("*", F.row_number().over(w).cast("long").alias("n"), F.sum("v").over(upto).alias("s"), F.count("*").over(upto).alias("c"),
                         F.last("w", True).over(upto).alias("last_w"), F.last("v", True).over(upto).alias("last_v"))
        assert got.columns == want.columns
        key = lambda r: r.id
        assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


def test_carry_of_an_empty_table(spark):
    df = spark.createDataFrame([], ROWS)
    assert carry(df, [], ["t", "id"], rank="n", sums={"s": "v"}, known={"x": "w"}).collect() == []
    assert quantiles(df.withColumn("x", F.col("id")), ["k"], "x", [50]).collect() == []


def test_a_hot_key_is_spread_over_tasks(spark):
    """A key with all rows, and no key at all: no task gets more than a few slices."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000).select(F.lit("hot").alias("k"), F.col("id"), (F.col("id") % 100).alias("v"))
        for keys in (["k"], []):
            out = carry(df, keys, ["id"], rank="n", sums={"s": "v"}, slice_rows=200)
            per_task = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.max(F.col("n") - F.col("id")).alias("off"))
            found = per_task.collect()
            assert sum(r.n for r in found) == 40_000 and max(r.n for r in found) < 4_000 and {r.off for r in found} == {1}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def disc(values, p):
    values = sorted(values)
    return values[max(1, -(-p * len(values) // 100)) - 1]


@pytest.mark.parametrize("slice_rows", [1, 5, 10 ** 9])
def test_quantiles_equal_sorting(spark, slice_rows):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None, "one"]), rng.choice([None, 0, 5, 5, rng.randrange(-50, 10 ** 12)]))
            for _ in range(600)] + [("single", 7), ("none", None)]
    got = {r.k: r for r in quantiles(spark.createDataFrame(rows, "k string, x long"), ["k"], "x", [0, 1, 50, 90, 95, 100], slice_rows=slice_rows).collect()}
    assert "none" not in got
    for key in {k for k, _ in rows} - {"none"}:
        values = [x for k, x in rows if k == key and x is not None]
        r = got[key]
        assert (r.n, r.max_x, r.avg_x) == (len(values), max(values), sum(values) / len(values))
        assert [r[f"p{p}_x"] for p in (1, 50, 90, 95, 100)] == [disc(values, p) for p in (1, 50, 90, 95, 100)]
        assert r.p0_x == min(values)


def test_service_levels_of_stays(spark):
    logs = spark.createDataFrame([(1, 1, ts("2024-01-01 00:00:10"), "Sector", None, "SALES"), (2, 1, ts("2024-01-01 00:00:30"), "Sector", None, "TYPING"),
                                  (3, 1, ts("2024-01-01 00:00:35"), "Sector", None, "SALES"), (4, 1, ts("2024-01-01 00:01:35"), "Sector", None, "COMPLETED"),
                                  (5, 2, ts("2024-01-01 00:00:00"), "Sector", None, "SALES"), (6, 2, ts("2024-01-01 00:00:01"), "Note", None, "x")], LOGS_SCHEMA)
    sales = spark.createDataFrame([followup(1, "u", "2024-01-01"), followup(2, "u", "2024-01-01")], FOLLOWUPS_SCHEMA)
    users = spark.createDataFrame([("u", "C", ts("2024-01-01"), False, None)], USERS_SCHEMA)
    periods = state_periods(logs, sales, users)
    whole = {r.state: r for r in sla_summary(periods).collect()}
    assert (whole["SALES"].n, whole["SALES"].p50_duration_seconds, whole["SALES"].p95_duration_seconds, whole["SALES"].avg_duration_seconds) == (2, 1, 80, 40.5)
    single = {r.state: r for r in sla_summary(periods, ["state"], per_sale=False).collect()}
    assert (single["SALES"].n, single["SALES"].p50_duration_seconds, single["SALES"].max_duration_seconds) == (3, 20, 60)


@pytest.mark.parametrize("slice_rows", [3, 10 ** 9])
def test_purchase_numbers_of_a_hot_user_and_copies(spark, slice_rows):
    sales = A.followups(spark, SF).where("followup_id % 5 = 0").withColumn(
        "user_id", F.when(F.col("followup_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id")))
    sales = sales.unionByName(sales.where("followup_id % 7 = 0"))
    got = [tuple(r) for r in purchase_numbers(sales, slice_rows=slice_rows).collect()]
    rows = sorted((r for r in sales.collect() if r.status == "Finalizado" and r.commission >= 0),
                  key=lambda r: (r.user_id, r.finalized_at or r.created_at, r.followup_id))
    want, number, total = [], {}, {}
    for r in rows:
        number[r.user_id] = number.get(r.user_id, 0) + 1
        total[r.user_id] = total.get(r.user_id, 0) + r.commission
        want.append((r.user_id, r.followup_id, r.finalized_at or r.created_at, number[r.user_id], float(r.commission), float(total[r.user_id])))
    assert sorted(got) == sorted(want) and max(n for *_, n, _, _ in want) > len(want) / 4


@pytest.mark.parametrize("slice_rows", [10, 10 ** 9])
def test_cumulative_commission_of_a_hot_client_and_day(spark, slice_rows):
    contracts = A.contracts(spark, SF).where("contract_id % 4 = 0").withColumn(
        "client_key", F.when(F.col("contract_id") % 3 == 0, F.lit("hot")).otherwise(F.col("client_key"))).withColumn(
        "paid_at", F.when(F.col("contract_id") % 5 == 0, F.lit("1996-02-29 12:00:00").cast("timestamp_ntz")).otherwise(F.col("paid_at")))
    got = {r.contract_id: r for r in cumulative_commission(contracts, slice_rows=slice_rows).collect()}
    rows = sorted((r for r in contracts.collect() if r.client_key and r.paid_at and r.commission >= 0), key=lambda r: (r.paid_at, r.contract_id))
    assert len(got) == len(rows) > 300
    total, own = 0, {}
    for i, r in enumerate(rows, 1):
        total += r.commission
        own[r.client_key] = own.get(r.client_key, 0) + r.commission
        found = got[r.contract_id]
        assert (found.contract_number, found.cumulative_commission, found.client_commission) == (i, float(total), float(own[r.client_key]))


def test_no_row_window_without_a_bounded_key(spark):
    """The windows over rows run by (keys, period, slice); only the one over cells may be a single task."""
    plan = cumulative_commission(A.contracts(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    spans = [line for line in plan.split("\n") if "Window [" in line]
    assert spans and all("_slice" in line for line in spans)
    assert any("ROWS" in line or "specifiedwindowframe(RowFrame" in line for line in spans)


LOG_ROWS = [
    (1, 1, "2024-09-01 08:00:00", "Sector", "UNDEFINED", "SALES"),              # nobody in office yet
    (2, 1, "2024-09-01 09:00:00", "Stage Responsible", None, "ann"),
    (3, 1, "2024-09-01 10:00:00", "Sector", "SALES", "TYPING"),                 # ann
    (4, 1, "2024-09-01 11:00:00", "Sector", "TYPING", "FORMALIZATION"),         # ann: the row before is a change
    (5, 1, "2024-09-01 12:00:00", "Stage Responsible", "ann", None),            # no name: ann stays
    (6, 1, "2024-09-01 13:00:00", "Sector", "FORMALIZATION", "CANCELED"),       # ann
    (9, 1, "2024-09-01 14:00:00", "Stage Responsible", "ann", "bob"),           # same instant as the change, later id
    (8, 1, "2024-09-01 14:00:00", "Sector", "CANCELED", "SALES"),               # bob
    (10, 1, "2024-09-01 14:00:00", "Note", None, "x"),
    (11, 2, "2024-09-01 08:00:00", "Stage Responsible", None, "eve"),
    (12, 2, "2024-09-01 08:00:00", "Sector", "UNDEFINED", None),                # a change to NULL stays a change
    (13, 3, "2024-09-01 08:00:00", "Sector", "UNDEFINED", "SALES"),             # sale too old
    (14, None, "2024-09-01 08:00:00", "Sector", "UNDEFINED", "SALES"),
]


@pytest.mark.parametrize("slice_rows", [1, 2, 10 ** 9])
def test_responsible_in_office(spark, slice_rows):
    logs = spark.createDataFrame([(i, s, ts(t), f, o, n) for i, s, t, f, o, n in LOG_ROWS], LOGS_SCHEMA)
    sales = spark.createDataFrame([followup(1, "u", "2024-08-02"), followup(2, "u", "2024-08-01"), followup(3, "u", "2024-07-31")], FOLLOWUPS_SCHEMA)
    users = spark.createDataFrame([("u", "C", ts("2024-01-01"), False, None)], USERS_SCHEMA)
    got = {r.log_id: (r.stage_responsible, r.is_conversion) for r in responsible_as_of(logs, sales, users, slice_rows=slice_rows).collect()}
    assert got == {1: (None, 1), 3: ("ann", 1), 4: ("ann", 1), 6: ("ann", 0), 8: ("bob", 0), 12: ("eve", 0)}


def test_responsible_of_a_hot_sale_equals_brute_force(spark):
    logs = A.event_logs(spark, SF).withColumn("followup_id", F.when(F.col("log_id") % 3 == 0, F.lit(5).cast("long")).otherwise(F.col("followup_id")))
    sales, users = A.customer_followups(spark, SF), A.users(spark, SF)
    got = sorted(((r.log_id, r.stage_responsible, r.responsible_since) for r in
                  responsible_as_of(logs, sales, users, since=None, slice_rows=50).collect()), key=lambda r: r[0])
    known = {r.followup_id for r in sales.collect()}
    want, office = [], {}
    rows = [r for r in logs.collect() if r.followup_id in known and r.changed_field in ("Sector", "Stage Responsible")]
    for r in sorted(rows, key=lambda r: (r.log_date, r.changed_field == "Sector", r.log_id)):
        if r.changed_field == "Sector":
            want.append((r.log_id, *office.get(r.followup_id, (None, None))))
        elif r.updated_content is not None:
            office[r.followup_id] = (r.updated_content, r.log_date)
    assert got == sorted(want, key=lambda r: r[0]) and sum(x is not None for _, x, _ in want) > 100


def test_newest_leads_of_a_hot_registry(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"u{i % 50}", None if i % 11 == 0 else f"L{i}", "SIAPE", 0, True, True, False, False,
             None if i % 17 == 0 else str(i % 2), None if i % 13 == 0 else ts(f"2024-01-0{rng.randrange(1, 9)}"), i) for i in range(900)]
    leads = spark.createDataFrame(rows, LEADS_SCHEMA).repartition(4)
    got = sorted(((r.user_id, str(r.registry_no), r["rank"], r.lead_id) for r in newest_leads(leads).collect()))
    want = []
    groups = {}
    for r in rows:
        if r[1] is not None:
            groups.setdefault((r[0], str(r[8])), []).append(r)
    for (user, registry), own in groups.items():
        own.sort(key=lambda r: (r[9] is not None, -(r[9].timestamp() if r[9] else 0), -r[10]))
        want += [(user, registry, i, r[1]) for i, r in enumerate(own[:3], 1)]
    assert got == sorted(want)


def test_newest_rows_are_limited_before_the_exchange(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = newest_per_key(df, ["k"], [F.col("id").desc()], 3)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.split("\n") if "WindowGroupLimit" in line or "Exchange" in line]
    assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]


def test_unique_or_fail_is_lazy_and_names_the_key(spark):
    good = spark.createDataFrame([(1, "a", None), (2, None, 3), (None, "c", 4)], "k int, a string, b int")
    assert sorted(unique_or_fail(good, ["k"]).collect(), key=str) == sorted(good.collect(), key=str)
    assert unique_or_fail(good, ["k"]).columns == good.columns
    bad = unique_or_fail(good.unionByName(good.where("k = 2")), ["k"], "users")       # no job yet
    for read in (bad, bad.select("k"), bad.select(F.count("*"))):
        with pytest.raises(Exception, match=r"users: key \['k'\] is not unique: 2"):
            read.collect()


def test_ranked_is_row_number(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, x int")
    assert sorted(map(tuple, ranked(df, ["k"], ["x"]).collect())) == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]
