"""Event-path edge list for flow (Sankey) diagrams (V6).

A user's registration row (one per user, creation date, origin, platform
and covenant, with the first registration event time) walks a chain of
*states*.  A state's time is the user's **global** first touch of any of
its events.  A transition from a parent node to a state holds when the
parent's time is strictly earlier than the state's first touch; the time
carried on is the state's.  Labelled transitions are the emitted edges;
the output counts, per (step_order, source, target), the registration rows
whose chain holds (COUNT(*) of rows, not distinct users; zero edges are
absent).

Reference semantics kept (SURVEY 2.6): first touch is global, not "first
after the previous step", so an early touch blocks a later one for good;
equal times fail; a user on two platforms has two registration rows and
counts twice; only listed covenants and listed event ids are read.

Here the graph is data (``PathGraph``): states with their event ids, and each labelled edge
as the chain of states a user passes.  Edge 6 follows its label chain by default (after edge
5); ``literal_edge6=True`` gives the chain through the blocked buttons, D2.  ``all_chains``
has all 37 ways, also the 20 that no edge shows (names resolved as in SURVEY 2.6, D1).

Plan: one filtered scan of events (pushed IN filter), one aggregation per
(user, platform) holding the registration time and one ``min(when(...))``
column per state (partial aggregation makes a bot user with millions of
events cheap), a window over the few platform rows of each user for the
user-level minima, a join to users, then every transition is a conjunction
of column comparisons and the matched edges are exploded and counted - one
shuffle of partial aggregates, one of per-(user, platform) rows and one of
the (at most a few dozen) edge keys; no self-join, no nested-loop join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The reference's covenant filter (the default of event_paths).
COVENANTS = ("PREFEITURA DE GOIÂNIA", "GOVERNO DO RIO DE JANEIRO", "GOVERNO DE AMAZONAS",
             "GOVERNO DO PARANÁ")


@dataclass(frozen=True)
class State:
    name: str
    events: tuple[str, ...]


@dataclass(frozen=True)
class Edge:
    """Emitted edge: a label and the states a user passes, in order, to count for it."""
    step_order: int
    source: str
    target: str
    chain: tuple[str, ...]


@dataclass(frozen=True)
class PathGraph:
    registration_events: tuple[str, ...]
    states: tuple[State, ...]
    edges: tuple[Edge, ...]

    def used_states(self) -> list[State]:
        used = {s for e in self.edges for s in e.chain}
        return [s for s in self.states if s.name in used]

    def event_ids(self, states: Sequence[State] | None = None) -> list[str]:
        """Registration ids and those of the given states (default: those on edges)."""
        ids = list(self.registration_events)
        for s in self.used_states() if states is None else states:
            ids.extend(s.events)
        return list(dict.fromkeys(ids))


def _state_col(name: str) -> str:
    return f"_st_{name}"


def first_touch_times(events: DataFrame, graph: PathGraph, states: Sequence[State] | None = None) -> DataFrame:
    """One row per (user_id, platform): first registration time on that
    platform (``_reg_at``) and the user's global first touch of every state
    (``_st_<name>``, minimum over all platforms).

    One scan and one partial aggregation per (user, platform); the per-user
    minimum is a window over those few rows per user, so registration rows
    and states come from the same pipeline (no second scan of events).
    """
    states = graph.used_states() if states is None else states
    ev = events.where(F.col("event_name").isin(*graph.event_ids(states)))
    reg_time = F.min(F.when(F.col("event_name").isin(*graph.registration_events),
                            F.col("event_at"))).alias("_reg_at")
    per_platform = ev.groupBy("user_id", "platform").agg(
        reg_time,
        *[F.min(F.when(F.col("event_name").isin(*s.events), F.col("event_at")))
          .alias(_state_col(s.name)) for s in states])
    per_user = Window.partitionBy("user_id")
    return per_platform.select(
        "user_id", "platform", "_reg_at",
        *[F.min(_state_col(s.name)).over(per_user).alias(_state_col(s.name)) for s in states])


def event_states(events: DataFrame, users: DataFrame, graph: PathGraph | None = None, *,
                 covenants: Sequence[str] | None = COVENANTS) -> DataFrame:
    """Long form of the first-touch pivot: (user_id, state, first_at) of every state of the graph.

    ``graph`` defaults to the reference graph and ``covenants`` to its four
    covenants; ``covenants=None`` reads every user."""
    graph = graph or DEFAULT_GRAPH
    users = _filter_users(users, covenants)
    states = graph.states
    pivot = (first_touch_times(events, graph, states)
             .groupBy("user_id").agg(*[F.min(_state_col(s.name)).alias(_state_col(s.name))
                                       for s in states])
             .join(users.select("user_id").distinct(), "user_id", "left_semi"))
    stacked = F.explode(F.array(*[F.struct(F.lit(s.name).alias("state"),
                                           F.col(_state_col(s.name)).alias("first_at"))
                                  for s in states])).alias("_s")
    return (pivot.select("user_id", stacked)
            .where(F.col("_s.first_at").isNotNull())
            .select("user_id", "_s.state", "_s.first_at"))


def _filter_users(users: DataFrame, covenants: Sequence[str] | None) -> DataFrame:
    if covenants is None:
        return users
    return users.where(F.col("covenant").isin(*covenants))


def _chain_holds(chain: Sequence[str]) -> Column:
    times = [F.col("_reg_at")] + [F.col(_state_col(s)) for s in chain]
    return reduce(lambda a, b: a & b, [a < b for a, b in zip(times, times[1:])])


def event_paths(events: DataFrame, users: DataFrame, graph: PathGraph | None = None, *,
                covenants: Sequence[str] | None = COVENANTS) -> DataFrame:
    """Edge list (step_order, source, target, users).

    ``graph`` defaults to the reference graph and ``covenants`` to its four
    covenants; ``covenants=None`` reads every user."""
    graph = graph or DEFAULT_GRAPH
    users = _filter_users(users, covenants)
    # Events are reduced per (user, platform) before any join, also with a covenant
    # filter: a semi-join before would shuffle raw events, the partial aggregates are
    # a row per (task, user, platform).
    states = [_state_col(s.name) for s in graph.used_states()]
    regs = first_touch_times(events, graph).where(F.col("_reg_at").isNotNull())
    # GROUP BY the five registration attributes, as the reference does; the
    # data is already hash-partitioned by user_id here, so no new exchange.
    # Distinct registration attributes first: copies of a user row collapse
    # map-side instead of multiplying through the join into one task.
    attrs = users.select("user_id", F.col("created_at").alias("_created"),
                         F.col("source_platform").alias("_origin"), "covenant").distinct()
    rows = (regs.join(attrs, "user_id")
            .groupBy("user_id", "_created", "_origin", "platform", "covenant")
            .agg(F.min("_reg_at").alias("_reg_at"), *[F.first(c).alias(c) for c in states]))
    matched = F.array(*[F.when(_chain_holds(e.chain),
                               F.struct(F.lit(e.step_order).alias("step_order"),
                                        F.lit(e.source).alias("source"),
                                        F.lit(e.target).alias("target")))
                        for e in graph.edges])
    edges = rows.select(F.explode(F.filter(matched, lambda x: x.isNotNull())).alias("_e"))
    return (edges.groupBy(F.col("_e.step_order").alias("step_order"),
                          F.col("_e.source").alias("source"),
                          F.col("_e.target").alias("target"))
            .agg(F.count(F.lit(1)).alias("users")))


# ---------------------------------------------------------------------------
# The registration event ids and the 29 first-touch states with their event
# ids.  The source also filters events to a 66-id list; ids used by no state cannot change
# any count, so the scan filter is the set of ids in use (``PathGraph.event_ids``).
REGISTRATION_EVENTS = ("registration_completed", "registration_completed_sms",
                       "registration_completed_email")
STATES = (
    State("viewed_bank_wheel_no_password", ("view_lead_async_load_without_password",
                                            "view_bank_wheel_screen_without_password", "splash_screen_view")),
    State("support_on_bank_wheel_screen", ("clicked_load_async_support_without_psw",)),
    State("support_on_bank_wheel_screen_with_password", ("clicked_load_async_support_with_psw",)),
    State("lead_success_no_password", ("lead_generation_success", "lead_generation_success_api")),
    State("lead_failure_no_password", ("lead_generation_failed",)),
    State("unavailable_access_screen", ("opened_unavailable_access_screen",)),
    State("registries_screen_after_unavailable_access", ("opened_easy_consig_registries_screen",
                                                         "opened_registries_screen")),
    State("gave_password_after_unavailable_access", ("gave_password",)),
    State("support_on_unavailable_access_screen", ("clicked_support_unavailable_access",)),
    State("support_on_registry_screen_after_unavailable_access", ("clicked_registries_screen_support_button",
                                                                  "clicked_easy_consig_registries_support")),
    State("support_on_password_screen_after_unavailable_access", ("clicked_credentials_support_with_psw",)),
    State("no_linked_registry", ("no_lead_user_is_unlinked",)),
    State("instability_screen", ("open_instability_error_screen",)),
    State("no_lead_confirmation_screen", ("no_lead_covenant_confirmation_screen",)),
    State("wrong_registry_or_password_screen", ("opened_wrong_psw_screen", "open_credentials_error_screen")),
    State("blocked_user_screen", ("open_blocked_access_screen",)),
    State("clicked_blocked_buttons", ("clicked_blocked_portability_button", "clicked_blocked_max_change_button",
                                      "clicked_blocked_fit_change_button", "clicked_blocked_instlment_red_btn",
                                      "clicked_blocked_benefit_card")),
    State("credentials_screen_after_blocked_buttons", ("credentials_screen_opened", "opened_dashboard_psw_screen")),
    State("gave_password_on_credentials_screen", ("gave_password", "gave_password_on_dashboard")),
    State("clicked_reset_password_on_credentials_screen", ("clicked_open_password_recovery",
                                                           "clicked_recovery_password_with_psw")),
    State("clicked_support_on_credentials_screen", ("clicked_credentials_support_with_psw",)),
    State("clicked_new_credit", ("clicked_new_credit",)),
    State("no_new_credit_opportunity", ("entered_new_credit_no_opportunity",)),
    State("opened_new_credit_opportunities_screen", ("opened_new_credit_oportunities_view",)),
    State("opened_contracting_credentials_screen", ("opened_contracting_psw_screen", "credentials_screen_opened")),
    State("provided_password_on_contracting_screen", ("gave_password", "gave_psw_during_contracting")),
    State("viewed_bank_wheel_with_password", ("view_lead_async_load_with_password",
                                              "view_bank_wheel_screen_with_password", "splash_screen_view")),
    State("lead_success_with_password", ("lead_gen_with_psw_success", "lead_generation_success_api")),
    State("lead_failure_with_password", ("lead_gen_with_psw_failed",)),
)
# ---------------------------------------------------------------------------


def _chains(literal_edge6: bool) -> dict[str, tuple[str, ...]]:
    """The stations on the way, each as the states passed before and at it."""
    at: dict[str, tuple[str, ...]] = {"start": ()}

    def go(station: str, before: str, state: str) -> None:
        at[station] = (*at[before], state)

    go("wheel", "start", "viewed_bank_wheel_no_password")
    go("lead", "wheel", "lead_success_no_password")
    go("no lead", "wheel", "lead_failure_no_password")
    go("no access", "no lead", "unavailable_access_screen")
    go("option", "lead", "clicked_new_credit")
    go("blocked button", "lead", "clicked_blocked_buttons")
    go("first login", "blocked button", "credentials_screen_after_blocked_buttons")
    go("first password", "first login", "gave_password_on_credentials_screen")
    go("opportunities", "blocked button" if literal_edge6 else "option", "opened_new_credit_opportunities_screen")
    go("second login", "opportunities", "opened_contracting_credentials_screen")
    go("second password", "second login", "gave_password_on_credentials_screen")
    for turn in ("first", "second"):
        go(f"{turn} wheel", f"{turn} password", "viewed_bank_wheel_with_password")
        go(f"{turn} lead", f"{turn} wheel", "lead_success_with_password")
        go(f"{turn} no lead", f"{turn} wheel", "lead_failure_with_password")
    return at


def all_chains(literal_edge6: bool = False) -> list[tuple[str, ...]]:
    """Every way of the source: the 17 that are emitted and the 20 that are only defined."""
    at = _chains(literal_edge6)
    ways = [c for c in at.values() if c]
    ends = {"wheel": ["support_on_bank_wheel_screen"], "lead": ["no_linked_registry"],
            "no lead": ["blocked_user_screen", "no_lead_confirmation_screen", "instability_screen"],
            "no access": ["registries_screen_after_unavailable_access", "support_on_unavailable_access_screen"],
            "blocked button": ["no_new_credit_opportunity"]}
    for turn in ("first", "second"):
        ends[f"{turn} login"] = ["clicked_reset_password_on_credentials_screen", "clicked_support_on_credentials_screen"]
        ends[f"{turn} wheel"] = ["support_on_bank_wheel_screen_with_password"]
        ends[f"{turn} lead"] = ["no_linked_registry"]
        ends[f"{turn} no lead"] = ["blocked_user_screen", "wrong_registry_or_password_screen"]
    return ways + [(*at[station], state) for station, states in ends.items() for state in states]


def default_graph(literal_edge6: bool = False) -> PathGraph:
    """The 17 emitted edges.  Edge 6 (and everything behind it) starts from 'Clicked New
    Option' (edge 5) unless ``literal_edge6``, which keeps the way through the blocked
    buttons as literally written (D2)."""
    at = _chains(literal_edge6)
    # Step, source and target labels; then the station and the state that ends the edge.
    labels = [
        (1, "Registration Completed", "Bank Wheel", at["wheel"]),
        (2, "Bank Wheel", "Support - Bank Wheel", (*at["wheel"], "support_on_bank_wheel_screen")),
        (3, "Bank Wheel", "Lead Without Password", at["lead"]),
        (4, "Lead Without Password", "Unlinked User", (*at["lead"], "no_linked_registry")),
        (5, "Lead Without Password", "Clicked New Option", at["option"]),
        (6, "Clicked New Option", "Viewed New Opportunities Screen", at["opportunities"]),
        (7, "Viewed New Opportunities Screen", "Credential Screen 2", at["second login"]),
        (8, "Credential Screen 2", "Reset Password 2", (*at["second login"], "clicked_reset_password_on_credentials_screen")),
        (9, "Credential Screen 2", "Support 2", (*at["second login"], "clicked_support_on_credentials_screen")),
        (10, "Credential Screen 2", "Entered Password 2", at["second password"]),
        (11, "Entered Password 2", "Bank Wheel With Password 2", at["second wheel"]),
        (12, "Bank Wheel With Password 2", "Support - Bank Wheel 3",
         (*at["second wheel"], "support_on_bank_wheel_screen_with_password")),
        (13, "Bank Wheel With Password 2", "Lead With Password 2", at["second lead"]),
        (14, "Lead With Password 2", "Unlinked User 3", (*at["second lead"], "no_linked_registry")),
        (15, "Bank Wheel With Password 2", "Lead With Password Failed 2", at["second no lead"]),
        (16, "Lead With Password Failed 2", "User Blocked 3", (*at["second no lead"], "blocked_user_screen")),
        (17, "Lead With Password Failed 2", "Wrong Credentials 2",
         (*at["second no lead"], "wrong_registry_or_password_screen")),
    ]
    return PathGraph(REGISTRATION_EVENTS, STATES, tuple(Edge(*e) for e in labels))


DEFAULT_GRAPH = default_graph()
