"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each entry wires adapters (driver tables -> logical tables) into one
operator with the parameters that fit the driver data (dates of the driver
tables are 1995-2001 for orders and January 2024 for events, so the two date
cut-offs are moved accordingly; every other parameter is the reference
default).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from flowlens.functions.semantics import (
    first_per_key,
    is_present,
    latest_per_key,
    month_start,
    running_total,
    seconds_between,
)
from flowlens.functions.sequence import with_neighbor
from flowlens.operators import funnel as V5
from flowlens.operators import growth as V4
from flowlens.operators.durations import sla_summary, state_durations, state_periods
from flowlens.operators.paths import (
    DEFAULT_GRAPH,
    Edge,
    PathGraph,
    State,
    all_chains,
    default_graph,
    event_paths,
    event_states,
)
from flowlens.operators.purchases import first_vs_repeat, purchase_numbers, purchases_by_number
from flowlens.operators.sequences import ordered_paths, ordered_steps
from flowlens.operators.transitions import forward_conversions, responsible_as_of, stage_responsible
from flowlens.sources import adapters as A
from flowlens.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

# Driver-data parameters (the reference defaults are 2024-08-01 and
# 2022-01-01; the driver's sales start 2024-01-01 and its months 1995-01).
# The path queries pass covenants=None: the driver's covenants are derived
# names, none of them in the reference's four-covenant list.
STAGE_RESPONSIBLE_SINCE = "2024-01-01"
GROWTH_SINCE = "1996-01-01"
LINEITEM_TIEBREAK = ["log_id", "log_part", "log_supp"]

# Path graph over the driver's event types: registration = signup; states
# are the other four types; edges signup->view, view->error, view->click,
# click->purchase, purchase->error.
DRIVER_GRAPH = PathGraph(
    registration_events=("signup",),
    states=(State("view", ("view",)), State("click", ("click",)),
            State("error", ("error",)), State("purchase", ("purchase",))),
    edges=(Edge(1, "Signup", "View", ("view",)),
           Edge(2, "View", "Error", ("view", "error")),
           Edge(3, "View", "Click", ("view", "click")),
           Edge(4, "Click", "Purchase", ("view", "click", "purchase")),
           Edge(5, "Purchase", "Error", ("view", "click", "purchase", "error"))),
)
# Part of the driver's covenants, and a cut-off inside the creation dates of its sales.
SOME_COVENANTS = [f"NATION_{n} {m}" for n in (10, 11, 16, 17, 19, 20)
                  for m in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")]
RECENT_SINCE = "2024-01-15"


# Ordered paths over the driver's event types; a kind may come again and a step may have several.
ORDERED_PATHS = {
    "buy": [["signup"], ["view"], ["click"], ["purchase"]],
    "retry": [["view"], ["error"], ["view"], ["error"], ["view"]],
    "again": [["signup", "view"], ["click", "error"], ["purchase"], ["purchase"]],
}


def _walks(literal_edge6: bool) -> list[list[str]]:
    """All 37 ways of the reference graph, and a way to each state on none, as event names: a registration, then each state's first event."""
    events = {s.name: s.events[0] for s in DEFAULT_GRAPH.states}
    registered = DEFAULT_GRAPH.registration_events
    ways = all_chains(literal_edge6)
    ways += [(s,) for s in events if all(s not in way for way in ways)]
    return [[registered[i % len(registered)], *[events[s] for s in way]] for i, way in enumerate(ways)]


def _ways_graph() -> PathGraph:
    """Every way of the reference graph as an edge of its own, also the 20 that the report leaves out."""
    ways = sorted(all_chains())
    return PathGraph(DEFAULT_GRAPH.registration_events, DEFAULT_GRAPH.states,
                     tuple(Edge(i, "Registration", " > ".join(chain), chain) for i, chain in enumerate(ways, 1)))


def q_first_vs_repeat(spark: SparkSession, sf: str) -> DataFrame:
    return first_vs_repeat(A.followups(spark, sf), A.operators(spark, sf),
                           A.users(spark, sf), A.client_ids(spark, sf))


def q_state_durations(spark: SparkSession, sf: str) -> DataFrame:
    return state_durations(A.lineitem_logs(spark, sf), A.followups(spark, sf),
                           A.users(spark, sf), tiebreak=LINEITEM_TIEBREAK)


def q_state_durations_events(spark: SparkSession, sf: str) -> DataFrame:
    return state_durations(A.event_logs(spark, sf), A.customer_followups(spark, sf),
                           A.users(spark, sf), tiebreak=["log_id"])


def q_state_periods(spark: SparkSession, sf: str) -> DataFrame:
    return state_periods(A.lineitem_logs(spark, sf), A.followups(spark, sf),
                         A.users(spark, sf), tiebreak=LINEITEM_TIEBREAK)


def q_stage_responsible(spark: SparkSession, sf: str) -> DataFrame:
    return stage_responsible(A.event_logs(spark, sf), A.customer_followups(spark, sf),
                             A.users(spark, sf), since=STAGE_RESPONSIBLE_SINCE)


def q_stage_responsible_recent(spark: SparkSession, sf: str) -> DataFrame:
    """Only sales created since a date inside the data."""
    return stage_responsible(A.event_logs(spark, sf), A.customer_followups(spark, sf),
                             A.users(spark, sf), since=RECENT_SINCE)


def q_forward_conversions(spark: SparkSession, sf: str) -> DataFrame:
    return forward_conversions(q_stage_responsible(spark, sf))


def q_responsible_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Every stage change with the responsible in office."""
    return responsible_as_of(A.event_logs(spark, sf), A.customer_followups(spark, sf), A.users(spark, sf), since=RECENT_SINCE)


def q_sla_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Service levels per covenant and stage, a sale's time in a stage as one stay."""
    return sla_summary(q_state_periods(spark, sf))


def q_sla_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Service levels per stage over single periods."""
    return sla_summary(q_state_periods(spark, sf), ["state"], per_sale=False)


def q_purchase_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return purchase_numbers(A.followups(spark, sf))


def q_purchases_by_number(spark: SparkSession, sf: str) -> DataFrame:
    return purchases_by_number(q_purchase_numbers(spark, sf))


def q_cumulative_commission(spark: SparkSession, sf: str) -> DataFrame:
    return V4.cumulative_commission(A.contracts(spark, sf))


# ------------------------------------------------------------------- V4
def q_monthly_growth(spark: SparkSession, sf: str) -> DataFrame:
    return V4.monthly_growth(A.users(spark, sf), A.leads(spark, sf), A.contracts(spark, sf),
                             since=GROWTH_SINCE)


def q_monthly_growth_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Every calendar month, cumulative columns carried on."""
    return V4.monthly_growth(A.users(spark, sf), A.leads(spark, sf), A.contracts(spark, sf), since=GROWTH_SINCE, dense=True)


def q_first_appearance_month(spark: SparkSession, sf: str) -> DataFrame:
    return V4.first_appearance_month(A.users(spark, sf), "user_id", "created_at")


def q_cumulative_new_users(spark: SparkSession, sf: str) -> DataFrame:
    return V4.new_users(A.users(spark, sf))


def q_cumulative_new_covenants(spark: SparkSession, sf: str) -> DataFrame:
    return V4.new_covenants(A.users(spark, sf))


def q_qualified_leads(spark: SparkSession, sf: str) -> DataFrame:
    return V4.qualified_leads(A.users(spark, sf), A.leads(spark, sf))


def q_monthly_clients(spark: SparkSession, sf: str) -> DataFrame:
    out = V4.monthly_clients(V4.client_months(A.contracts(spark, sf)))
    return out.withColumn("total_commission", F.col("total_commission").cast("double"))


def q_first_month_commission(spark: SparkSession, sf: str) -> DataFrame:
    new, commission = V4.first_month_commission(V4.client_months(A.contracts(spark, sf)))
    return (new.join(commission, "month", "left")
            .withColumn("first_purchase_commission",
                        F.col("first_purchase_commission").cast("double")))


# ------------------------------------------------------------------- V5
def _funnel_inputs(spark: SparkSession, sf: str):
    return (A.users(spark, sf), A.leads(spark, sf), A.proposal_events(spark, sf),
            A.followups(spark, sf), A.status_logs(spark, sf))


def q_daily_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return V5.daily_funnel(*_funnel_inputs(spark, sf))


def q_funnel_user_flags(spark: SparkSession, sf: str) -> DataFrame:
    return V5.funnel_user_flags(*_funnel_inputs(spark, sf))


def q_lead_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return V5.lead_verdict(A.leads(spark, sf), A.users(spark, sf))


def q_user_lead_status(spark: SparkSession, sf: str) -> DataFrame:
    return V5.user_lead_status(A.users(spark, sf), A.leads(spark, sf))


def q_funnel_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel's distinct users per month and covenant, merged from the days' bitmaps."""
    return V5.funnel_rollup(V5.funnel_bitmaps(q_funnel_user_flags(spark, sf)))


def q_funnel_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """The same per week and platform."""
    return V5.funnel_rollup(V5.funnel_bitmaps(q_funnel_user_flags(spark, sf)), "week", ["platform"])


def q_active_users(spark: SparkSession, sf: str) -> DataFrame:
    return V5.active_users(A.app_events(spark, sf))


def q_sales_after_registration(spark: SparkSession, sf: str) -> DataFrame:
    return V5.sales_after_registration(A.users(spark, sf), A.followups(spark, sf))


def q_newest_leads(spark: SparkSession, sf: str) -> DataFrame:
    return V5.newest_leads(A.leads(spark, sf))


def q_canceled_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return V5.canceled_incomplete(A.status_logs(spark, sf))


# ------------------------------------------------------------------- V6
def q_event_paths(spark: SparkSession, sf: str) -> DataFrame:
    return event_paths(A.app_events(spark, sf), A.users(spark, sf), DRIVER_GRAPH, covenants=None)


def q_event_paths_covenants(spark: SparkSession, sf: str) -> DataFrame:
    """Only users of some covenants."""
    return event_paths(A.app_events(spark, sf), A.users(spark, sf), DRIVER_GRAPH, covenants=SOME_COVENANTS)


def q_event_paths_reference_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's 17-edge graph over driver events renamed to its event ids."""
    events = A.app_events_named(spark, sf, sorted(DEFAULT_GRAPH.event_ids()))
    return event_paths(events, A.users(spark, sf), DEFAULT_GRAPH, covenants=None)


def q_event_paths_literal_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Same, with edge 6 on the literal (blocked-button) chain."""
    graph = default_graph(literal_edge6=True)
    events = A.app_events_named(spark, sf, sorted(graph.event_ids()))
    return event_paths(events, A.users(spark, sf), graph, covenants=None)


def q_event_states(spark: SparkSession, sf: str) -> DataFrame:
    return event_states(A.app_events(spark, sf), A.users(spark, sf), DRIVER_GRAPH, covenants=None)


def q_ordered_paths(spark: SparkSession, sf: str) -> DataFrame:
    return ordered_paths(A.app_events(spark, sf), A.users(spark, sf), ORDERED_PATHS)


def q_ordered_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Per user and path: steps made and when the last one was."""
    steps = ordered_steps(A.app_events(spark, sf), ORDERED_PATHS)
    return steps.select("user_id", "path", F.size("times").cast("long").alias("steps"), F.element_at("times", -1).alias("last_at"))


def q_event_paths_walks(spark: SparkSession, sf: str) -> DataFrame:
    """The reference graph over users who walk all its ways: every edge has users."""
    return event_paths(A.app_events_walking(spark, sf, _walks(False)), A.users(spark, sf), DEFAULT_GRAPH, covenants=None)


def q_event_paths_walks_literal(spark: SparkSession, sf: str) -> DataFrame:
    """The same with edge 6, and everything behind it, on the literal chain."""
    return event_paths(A.app_events_walking(spark, sf, _walks(True)), A.users(spark, sf), default_graph(literal_edge6=True), covenants=None)


def q_event_states_walks(spark: SparkSession, sf: str) -> DataFrame:
    """First touch of all 29 states."""
    return event_states(A.app_events_walking(spark, sf, _walks(False)), A.users(spark, sf), DEFAULT_GRAPH, covenants=None)


def q_path_ways(spark: SparkSession, sf: str) -> DataFrame:
    """Users on each of the 37 ways, also those that no edge shows."""
    return event_paths(A.app_events_walking(spark, sf, _walks(False)), A.users(spark, sf), _ways_graph(), covenants=None)


# ------------------------------------------------- shared building blocks
def q_seconds_between(spark: SparkSession, sf: str) -> DataFrame:
    """Second-boundary gap from each event to the user's next event."""
    ev = A.app_events(spark, sf).select("event_id", "user_id", "event_at")
    nxt = with_neighbor(ev, ["user_id"], ["event_at", "event_id"], ["event_at"], "next", "next_")
    return nxt.select("event_id", "user_id",
                      seconds_between("event_at", "next_event_at").alias("gap_seconds"))


def q_month_trunc(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per ship month (zone-free DATE_TRUNC month)."""
    li = read_table(spark, sf, "lineitem")
    return li.groupBy(month_start("l_shipdate").alias("month")).agg(
        F.count(F.lit(1)).alias("line_items"))


def q_present_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Users per present, known covenant (blank, NULL and 'desconhecido' dropped)."""
    users = A.users(spark, sf)
    kept = users.where(is_present("covenant") & ~F.col("covenant").ilike("desconhecido"))
    return kept.groupBy("covenant").agg(F.count(F.lit(1)).alias("users"))


def q_dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Newest lead row per (user, registry): created DESC NULLS FIRST, then sequence."""
    leads = A.leads(spark, sf).where(F.col("lead_id").isNotNull())
    return latest_per_key(leads, ["user_id", "registry_no"],
                          [F.col("created_at").isNull(), "created_at", "created_seq"],
                          ["lead_id", "created_at"])


def q_first_touch(spark: SparkSession, sf: str) -> DataFrame:
    """First time of each event type per user."""
    ev = A.app_events(spark, sf)
    return first_per_key(ev, ["user_id", "event_name"], ["event_at", "event_id"],
                         ["event_id", "event_at"])


def q_running_total(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per order month and their running total (NULL months last)."""
    o = read_table(spark, sf, "orders")
    per_month = o.groupBy(month_start("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"))
    return running_total(per_month, "month", "orders", "cumulative")


def queries() -> dict[str, Query]:
    return {
        "first_vs_repeat": q_first_vs_repeat,
        "state_durations": q_state_durations,
        "state_durations_events": q_state_durations_events,
        "state_periods": q_state_periods,
        "stage_responsible": q_stage_responsible,
        "stage_responsible_recent": q_stage_responsible_recent,
        "forward_conversions": q_forward_conversions,
        "monthly_growth": q_monthly_growth,
        "first_appearance_month": q_first_appearance_month,
        "cumulative_new_users": q_cumulative_new_users,
        "cumulative_new_covenants": q_cumulative_new_covenants,
        "qualified_leads": q_qualified_leads,
        "monthly_clients": q_monthly_clients,
        "first_month_commission": q_first_month_commission,
        "daily_funnel": q_daily_funnel,
        "funnel_user_flags": q_funnel_user_flags,
        "lead_verdict": q_lead_verdict,
        "user_lead_status": q_user_lead_status,
        "canceled_incomplete": q_canceled_incomplete,
        "event_paths": q_event_paths,
        "event_paths_covenants": q_event_paths_covenants,
        "event_states": q_event_states,
        "event_paths_reference_graph": q_event_paths_reference_graph,
        "event_paths_literal_graph": q_event_paths_literal_graph,
        "seconds_between": q_seconds_between,
        "month_trunc": q_month_trunc,
        "present_filter": q_present_filter,
        "dedupe_latest": q_dedupe_latest,
        "first_touch": q_first_touch,
        "running_total": q_running_total,
        "sla_summary": q_sla_summary,
        "sla_by_stage": q_sla_by_stage,
        "purchase_numbers": q_purchase_numbers,
        "purchases_by_number": q_purchases_by_number,
        "cumulative_commission": q_cumulative_commission,
        "responsible_as_of": q_responsible_as_of,
        "newest_leads": q_newest_leads,
        "monthly_growth_dense": q_monthly_growth_dense,
        "funnel_by_month": q_funnel_by_month,
        "funnel_by_week": q_funnel_by_week,
        "active_users": q_active_users,
        "sales_after_registration": q_sales_after_registration,
        "ordered_paths": q_ordered_paths,
        "ordered_steps": q_ordered_steps,
        "event_paths_walks": q_event_paths_walks,
        "event_paths_walks_literal": q_event_paths_walks_literal,
        "event_states_walks": q_event_states_walks,
        "path_ways": q_path_ways,
    }
