"""The literal join / window formulation of the six views on Spark, as a baseline.

formulation: row-number and lag windows per entity, chained joins, one scan per path
state, COUNT(DISTINCT) per measure.  Each function states that shape with plain DataFrame
calls over the same adapters.  It is a measuring stick, not a code path of the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.functions.semantics import day_start, is_present, month_start, seconds_between
from flowlens.operators.durations import STATES
from flowlens.operators.funnel import CANCELED_STATUS, INCOMPLETE_STATUSES, record_status
from flowlens.operators.paths import DEFAULT_GRAPH
from flowlens.operators.transitions import FORWARD_STEPS, STAGE_NAMES
from flowlens.plans import catalog
from flowlens.sources import adapters as A


def stage_responsible(spark: SparkSession, sf: str) -> DataFrame:
    rows = (A.event_logs(spark, sf).where(F.col("changed_field").isin("Sector", "Stage Responsible"))
            .join(A.customer_followups(spark, sf), "followup_id").join(A.users(spark, sf).select("user_id", "covenant"), "user_id")
            .where(F.col("created_at") >= F.lit(catalog.STAGE_RESPONSIBLE_SINCE).cast("timestamp_ntz")))
    owner = F.lag("updated_content").over(Window.partitionBy("followup_id").orderBy("log_date", "log_id"))
    step = F.struct("original_content", "updated_content").isin(
        [F.struct(F.lit(a), F.lit(b)) for a, b in FORWARD_STEPS])
    return (rows.withColumn("stage_responsible", owner)
            .where((F.col("changed_field") == "Sector") & (F.col("stage_responsible") != "")
                   & ~F.col("stage_responsible").isin(STAGE_NAMES))
            .withColumn("is_conversion", F.coalesce(step, F.lit(False)).cast("int")))


def state_durations(spark: SparkSession, sf: str) -> DataFrame:
    logs, sales = A.lineitem_logs(spark, sf), A.followups(spark, sf).join(A.users(spark, sf).select("user_id", "covenant"), "user_id")
    changes = logs.where("changed_field = 'Sector'")
    order = Window.partitionBy("followup_id").orderBy("log_date", *catalog.LINEITEM_TIEBREAK)
    last = logs.groupBy("followup_id").agg(F.max("log_date").alias("last"))
    first = changes.groupBy("followup_id").agg(F.min("log_date").alias("first"))
    done = changes.where("updated_content = 'COMPLETED'").groupBy("followup_id").agg(F.min("log_date").alias("done"))
    stays = changes.select("followup_id", F.col("updated_content").alias("state"), F.col("log_date").alias("a"),
                           F.lead("log_date").over(order).alias("b")).join(sales.select("followup_id"), "followup_id")
    opening = sales.join(first, "followup_id", "left").select("followup_id", F.lit("UNDEFINED").alias("state"),
                                                             F.col("created_at").alias("a"), F.col("first").alias("b"))
    stop = F.coalesce("done", "last")
    spans = (stays.union(opening).join(last, "followup_id", "left").join(done, "followup_id", "left")
             .where(F.col("state").isNotNull() & (F.col("a") <= stop))
             .withColumn("sec", seconds_between("a", F.least(F.coalesce("b", "last"), stop))))
    sums = [F.sum(F.when(F.col("state") == s, F.col("sec")).otherwise(0)).alias(f"time_{s.lower()}") for s in STATES]
    return spans.join(sales, "followup_id").groupBy("followup_id", "created_at", "operation", "origin_platform",
                                                    "covenant", "commission").agg(*sums)


def first_vs_repeat(spark: SparkSession, sf: str) -> DataFrame:
    rows = (A.followups(spark, sf).where((F.col("status") == "Finalizado") & (F.col("commission") >= 0) & is_present("user_id"))
            .join(A.operators(spark, sf), "seller_id", "left").join(A.users(spark, sf).select("user_id"), "user_id")
            .join(A.client_ids(spark, sf), "user_id"))
    order = Window.partitionBy("user_id").orderBy(F.coalesce("finalized_at", "created_at").asc_nulls_last(), "followup_id",
                                                  "client_key", "seller_name")
    return rows.withColumn("purchase_type", F.when(F.row_number().over(order) == 1, "First-time purchase")
                           .otherwise("Repeat purchase"))


def monthly_growth(spark: SparkSession, sf: str) -> DataFrame:
    users, leads, contracts = A.users(spark, sf), A.leads(spark, sf), A.contracts(spark, sf)

    def running(df: DataFrame, value: str, out: str) -> DataFrame:
        return df.withColumn(out, F.sum(value).over(Window.orderBy(F.col("month").asc_nulls_last())))

    def births(df: DataFrame, who: str, when: str, n: str, out: str) -> DataFrame:
        first = df.where(is_present(who)).groupBy(who).agg(F.min(month_start(when)).alias("month"))
        return running(first.groupBy("month").agg(F.count(who).alias(n)), n, out)

    paid = contracts.where(is_present("client_key") & F.col("paid_at").isNotNull() & (F.col("commission") >= 0))
    first = paid.groupBy("client_key").agg(F.min(month_start("paid_at")).alias("month"))
    qualified = (users.join(leads.where("lead_id IS NOT NULL").select("user_id", "lead_id"), "user_id")
                 .select("user_id", "lead_id", "created_at", "is_blocked").distinct()
                 .groupBy(month_start("created_at").alias("month")).count())
    opening = (paid.withColumn("month", month_start("paid_at")).join(first, ["client_key", "month"])
               .groupBy("month").agg(F.sum("commission").alias("opening")))
    paying = (paid.groupBy(month_start("paid_at").alias("month"))
              .agg(F.countDistinct("client_key").alias("clients"), F.sum("commission").alias("paid")))
    known = users.where(~F.col("covenant").ilike("desconhecido"))
    return (births(users, "user_id", "created_at", "n_users", "users")
            .join(births(known, "covenant", "created_at", "n_covenants", "covenants"), "month", "left")
            .join(running(qualified, "count", "qualified"), "month", "left")
            .join(births(paid, "client_key", "paid_at", "n_clients", "all_clients"), "month", "left")
            .join(paying, "month", "left").join(opening, "month", "left"))


def daily_funnel(spark: SparkSession, sf: str) -> DataFrame:
    users, leads = A.users(spark, sf), A.leads(spark, sf).where("lead_id IS NOT NULL")
    newest = Window.partitionBy("user_id", "registry_no").orderBy(F.col("created_at").desc_nulls_first(), F.desc("created_seq"))
    verdict = (leads.join(users.select("user_id").distinct(), "user_id", "left_semi").withColumn("s", record_status())
               .withColumn("n", F.row_number().over(newest)).where("n = 1").groupBy("user_id")
               .agg(F.max(F.col("s") == "valid").alias("valid"), F.max(F.col("s") == "Blocked").alias("stopped")))
    canceled = A.status_logs(spark, sf).where(F.col("original_content").isin(*INCOMPLETE_STATUSES)
                                              & (F.col("updated_content") == CANCELED_STATUS)).select("followup_id").distinct()
    sales = (A.followups(spark, sf).select("followup_id", F.col("user_id").alias("buyer"), F.col("created_at").alias("sold_at"), "status")
             .join(canceled.withColumn("gone", F.lit(True)), "followup_id", "left"))
    events = A.proposal_events(spark, sf).where("event_name = 'user_has_proposals'").select(
        F.col("user_id").alias("offered"), "event_at")
    u = users.join(leads.select("user_id", "lead_id"), "user_id", "left").join(verdict, "user_id", "left")
    day = day_start("created_at")
    rows = (u.join(events, (F.col("offered") == F.col("user_id")) & F.col("lead_id").isNotNull()
                   & (month_start("event_at") == month_start("created_at")), "left")
            .join(sales, (F.col("buyer") == F.col("offered")) & (F.datediff("sold_at", "created_at").between(0, 30)), "left"))
    fine = ~F.col("status").isin("Cancelado pelo usuário", *INCOMPLETE_STATUSES) & F.col("gone").isNull()
    free = ~F.coalesce("is_blocked", F.lit(False))
    return rows.groupBy(day.alias("day"), "covenant", F.coalesce("source_platform", F.lit("APP")).alias("platform")).agg(
        F.countDistinct("user_id").alias("a"), F.countDistinct("lead_id").alias("b"),
        F.countDistinct(F.when(F.col("valid") | F.col("stopped") | ~free, F.col("user_id"))).alias("c"),
        F.countDistinct(F.when(F.col("valid") & free, F.col("user_id"))).alias("d"),
        F.countDistinct("offered").alias("e"), F.countDistinct("buyer").alias("f"),
        F.countDistinct(F.when(fine, F.col("buyer"))).alias("g"),
        F.countDistinct(F.when(F.col("status") == "Finalizado", F.col("buyer"))).alias("h"))


def event_paths(spark: SparkSession, sf: str) -> DataFrame:
    graph = DEFAULT_GRAPH
    events = A.app_events_named(spark, sf, sorted(graph.event_ids())).join(
        A.users(spark, sf).select("user_id", "created_at", "source_platform", "covenant"), "user_id")
    start = (events.where(F.col("event_name").isin(*graph.registration_events))
             .groupBy("user_id", "created_at", "source_platform", "platform", "covenant").agg(F.min("event_at").alias("at")))
    first = Window.partitionBy("user_id").orderBy("event_at")
    touch = {s.name: events.where(F.col("event_name").isin(*s.events)).withColumn("n", F.row_number().over(first))
             .where("n = 1").select("user_id", F.col("event_at").alias("next")) for s in graph.used_states()}
    reached = {(): start}

    def reach(chain: tuple[str, ...]) -> DataFrame:
        if chain not in reached:
            reached[chain] = (reach(chain[:-1]).join(touch[chain[-1]], "user_id").where("at < next")
                              .withColumn("at", F.col("next")).drop("next"))
        return reached[chain]

    out = None
    for e in graph.edges:
        rows = reach(e.chain).select(F.lit(e.step_order).alias("step_order"), F.lit(e.source).alias("source"),
                                          F.lit(e.target).alias("target"))
        out = rows if out is None else out.union(rows)
    return out.groupBy("step_order", "source", "target").agg(F.count("*").alias("users"))


LITERAL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_responsible": stage_responsible, "state_durations": state_durations, "first_vs_repeat": first_vs_repeat,
    "monthly_growth": monthly_growth, "daily_funnel": daily_funnel, "event_paths_reference_graph": event_paths,
}
