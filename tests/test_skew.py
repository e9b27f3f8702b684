"""Skew: one sale holding a third of all log rows (derived from driver data).

The sliced plan (slice_rows small, so the hot sale is cut into many
slices) must give exactly the result of the plain plan, for the stage
durations (LEAD) and the responsible report (LAG)."""

import pytest
from pyspark.sql import functions as F

from flowlens.operators.durations import state_durations
from flowlens.operators.transitions import stage_responsible
from flowlens.plans import catalog
from flowlens.sources import adapters as A

SF = "/root/testdata/sf0.01"
HOT = 0  # every third order's line items are re-keyed onto sale 0


@pytest.fixture(scope="module")
def skewed_logs(spark):
    logs = A.lineitem_logs(spark, SF)
    hot = F.col("followup_id") % 3 == 0
    # keep rows distinct in the sale's total order: the old order key joins the tie-break
    return logs.select(F.when(hot, F.lit(HOT).cast("long")).otherwise(F.col("followup_id")).alias("followup_id"),
                       "log_date", "log_id", "log_part", "log_supp",
                       F.col("followup_id").alias("log_src"), "changed_field",
                       "original_content",
                       F.when(F.col("log_id") % 5 == 0, F.lit("agent")).otherwise(F.col("updated_content"))
                       .alias("updated_content"))


def test_hot_sale_is_a_third(skewed_logs):
    total = skewed_logs.count()
    hot = skewed_logs.where(F.col("followup_id") == HOT).count()
    assert hot > total / 4


def test_sliced_durations_equal_plain(spark, skewed_logs):
    fu, users = A.followups(spark, SF), A.users(spark, SF)
    tb = [*catalog.LINEITEM_TIEBREAK, "log_src"]
    plain = state_durations(skewed_logs, fu, users, tiebreak=tb, slice_rows=10 ** 12)
    sliced = state_durations(skewed_logs, fu, users, tiebreak=tb, slice_rows=1_000)
    assert sorted(plain.collect()) == sorted(sliced.collect())


def test_sliced_responsible_equal_plain(spark, skewed_logs):
    logs = skewed_logs.withColumn(
        "changed_field", F.when(F.col("updated_content") == "agent", F.lit("Stage Responsible"))
        .otherwise(F.col("changed_field")))
    fu, users = A.followups(spark, SF), A.users(spark, SF)
    tb = [*catalog.LINEITEM_TIEBREAK, "log_src"]
    plain = stage_responsible(logs, fu, users, since=None, tiebreak=tb, slice_rows=10 ** 12)
    sliced = stage_responsible(logs, fu, users, since=None, tiebreak=tb, slice_rows=1_000)
    got, want = sorted(sliced.collect()), sorted(plain.collect())
    assert len(want) > 0 and got == want


def test_first_vs_repeat_hot_user_equals_row_number(spark):
    """A user with a third of all purchases: the aggregate-based first
    detection equals ROW_NUMBER over a user window (the reference shape)."""
    from collections import Counter

    from pyspark.sql import Window

    from flowlens.operators.purchases import FIRST, REPEAT, first_vs_repeat

    fu = A.followups(spark, SF)
    fu = fu.withColumn("user_id", F.when(F.col("followup_id") % 3 == 0, F.lit("1"))
                       .otherwise(F.col("user_id")))
    ops, users, ids = A.operators(spark, SF), A.users(spark, SF), A.client_ids(spark, SF)
    got = Counter(tuple(r) for r in first_vs_repeat(fu, ops, users, ids).collect())

    p = (fu.where((F.col("status") == "Finalizado") & (F.col("commission") >= 0)
                  & F.col("user_id").isNotNull() & (F.col("user_id") != ""))
         .join(ops, "seller_id", "left").join(users.select("user_id"), "user_id")
         .join(ids, "user_id"))
    w = Window.partitionBy("user_id").orderBy(
        F.coalesce("finalized_at", "created_at").asc_nulls_last(), "followup_id",
        F.col("client_key").asc_nulls_last())
    ref = p.withColumn("rn", F.row_number().over(w)).select(
        F.coalesce(F.trunc(F.to_date("finalized_at"), "MM"), F.trunc(F.to_date("created_at"), "MM"))
        .cast("timestamp_ntz").alias("month"),
        "user_id", "client_key", F.col("seller_name").alias("seller"),
        F.col("origin_platform").alias("platform"),
        F.when(F.col("rn") == 1, F.lit(FIRST)).otherwise(F.lit(REPEAT)).alias("purchase_type"),
        F.col("commission").cast("double").alias("commission"),
        F.col("finalized_at").alias("completion_date"), F.col("created_at").alias("creation_date"))
    want = Counter(tuple(r) for r in ref.collect())
    hot_rows = sum(n for row, n in got.items() if row[1] == "1")
    assert hot_rows > sum(got.values()) / 4
    assert got == want


def test_hot_sale_at_one_instant(spark, skewed_logs):
    """A third of all rows on one sale at ONE timestamp (a group of copies in
    time): the hot path collapses the instant, and still equals the plain plan."""
    logs = skewed_logs.withColumn(
        "log_date", F.when(F.col("followup_id") == HOT, F.lit("1999-06-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("log_date")))
    fu, users = A.followups(spark, SF), A.users(spark, SF)
    tb = [*catalog.LINEITEM_TIEBREAK, "log_src"]
    plain = state_durations(logs, fu, users, tiebreak=tb, slice_rows=10 ** 12)
    sliced = state_durations(logs, fu, users, tiebreak=tb, slice_rows=1_000)
    assert sorted(plain.collect()) == sorted(sliced.collect())


def test_user_copies_do_not_change_funnel_or_paths(spark):
    """5,000 copies of one user row: COUNT(DISTINCT) measures and the GROUP BY
    of registration rows are unchanged, and the copies collapse before joins."""
    from flowlens.operators.funnel import daily_funnel
    from flowlens.operators.paths import event_paths

    users = A.users(spark, SF)
    copies = (users.where(F.col("user_id") == "7")
              .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("_k"))
    many = users.unionByName(copies)
    args = (A.leads(spark, SF), A.proposal_events(spark, SF), A.followups(spark, SF),
            A.status_logs(spark, SF))
    from collections import Counter

    def bag(df):
        return Counter(tuple(r) for r in df.collect())

    assert bag(daily_funnel(many, *args)) == bag(daily_funnel(users, *args))
    graph = catalog.DRIVER_GRAPH
    ev = A.app_events(spark, SF)
    assert (bag(event_paths(ev, many, graph, covenants=None))
            == bag(event_paths(ev, users, graph, covenants=None)))


def test_responsible_hot_sale_at_one_instant(spark, skewed_logs):
    """Row-level LAG on a sale with a third of all rows at one timestamp: the
    instant is sub-sliced by the numeric tie-break and equals the plain plan."""
    logs = (skewed_logs
            .withColumn("log_date", F.when(F.col("followup_id") == HOT,
                                           F.lit("1999-06-01 00:00:00").cast("timestamp_ntz"))
                        .otherwise(F.col("log_date")))
            .withColumn("changed_field", F.when(F.col("updated_content") == "agent",
                                                F.lit("Stage Responsible"))
                        .otherwise(F.col("changed_field"))))
    fu, users = A.followups(spark, SF), A.users(spark, SF)
    tb = [*catalog.LINEITEM_TIEBREAK, "log_src"]
    plain = stage_responsible(logs, fu, users, since=None, tiebreak=tb, slice_rows=10 ** 12)
    sliced = stage_responsible(logs, fu, users, since=None, tiebreak=tb, slice_rows=1_000)
    got, want = sorted(sliced.collect()), sorted(plain.collect())
    assert len(want) > 0 and got == want
