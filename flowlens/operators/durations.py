"""Seconds each entity spent in each state, from an entity-state log (V2).

A sale's log has rows (followup_id, log_date, changed_field, ...,
updated_content).  Rows whose ``changed_field`` is the state field open a
period in state ``updated_content`` that lasts until the next such row.  An
initial period in ``initial_state`` runs from the sale's creation to its
first state change.  Every period is capped at the first ``terminal_state``
time (or the last log time of any field) and measured in second boundaries.

Reference semantics kept (SURVEY 2.2):
* periods starting after the cap are dropped; sales with no log row at all
  vanish; durations are negative when the first change precedes creation;
* the cap is LEAST(COALESCE(end, max_log), COALESCE(completed, max_log));
* states outside ``states`` count nowhere, but still keep the sale's row;
* attributes come from followups joined (inner) to users.

Plan, one for every size (no self-join, no UNION ALL of the log):
* rows with a NULL sale are dropped at the scan (they match no sale);
* one partial aggregation per sale gives its bounds (last log time, first state change,
  first terminal time) and the splitters of its sequence (``functions/sequence``);
* rows of a sale at one instant collapse, by partial aggregation, to the last state row by
  tie-break: the others have 0-second periods.  A hot sale or instant, copies included, is
  merged before the shuffle;
* the next state change is a skew-safe LEAD over the instants, those with a state change
  first, so other fields never sit between two of them;
* per-sale conditional sums form the pivot; the initial period is computed per sale beside
  the attributes.
``state_periods`` keeps the state rows and takes the LEAD over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.carry import quantiles
from flowlens.functions.semantics import seconds_between, unique_or_fail
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS, is_splitter, neighbor_in_slices, splitters, with_neighbor

# The reference's seven stage names, in the order of its
# output columns.
STATES = ["UNDEFINED", "SALES", "TYPING", "FORMALIZATION", "PROGRESS", "COMPLETED", "CANCELED"]

ATTRIBUTES = ["followup_creation_date", "operation", "origin_platform", "covenant", "commission"]


def _attributes(followups: DataFrame, users: DataFrame) -> DataFrame:
    return (followups.join(users.select("user_id", "covenant"), "user_id")
            .select("followup_id",
                    F.col("created_at").alias("followup_creation_date"),
                    "operation", "origin_platform", "covenant",
                    F.col("commission").cast("double").alias("commission")))


def _bound_columns(is_state, terminal_state: str) -> list:
    return [F.max("log_date").alias("max_log"),
            F.min(F.when(is_state, F.col("log_date"))).alias("first_change"),
            F.min(F.when(is_state & (F.col("updated_content") == terminal_state), F.col("log_date"))).alias("done_at")]


def _bounds(logs: DataFrame, state_field: str, terminal_state: str) -> DataFrame:
    return logs.groupBy("followup_id").agg(*_bound_columns(F.col("changed_field") == state_field, terminal_state))


def _state_rows(logs: DataFrame, state_field: str, tiebreak: Sequence[str],
                slice_rows: int) -> DataFrame:
    rows = (logs.where(F.col("changed_field") == state_field)
            .select("followup_id", "log_date", *tiebreak,
                    F.col("updated_content").alias("state")))
    rows = with_neighbor(rows, ["followup_id"], ["log_date", *tiebreak], ["log_date"],
                         direction="next", prefix="next_", slice_rows=slice_rows, null_keys=False)
    return rows.select("followup_id", "state", F.col("log_date").alias("start_time"),
                       F.col("next_log_date").alias("end_time"))


def _capped(periods: DataFrame) -> DataFrame:
    """Apply the reference cap and filter to (start_time, end_time, state)."""
    cap = F.coalesce(F.col("done_at"), F.col("max_log"))
    end = F.least(F.coalesce(F.col("end_time"), F.col("max_log")), cap)
    return (periods.where(F.col("state").isNotNull() & (F.col("start_time") <= cap))
            .withColumn("end_time", end)
            .withColumn("duration_seconds", seconds_between("start_time", "end_time")))


def _per_sale(logs: DataFrame, state_field: str, terminal_state: str, states: Sequence[str],
              tiebreak: Sequence[str], slice_rows: int) -> DataFrame:
    """Per sale: bounds, number of kept state periods and seconds per state."""
    is_state = F.coalesce(F.col("changed_field") == state_field, F.lit(False))
    order, values = ["_other", "log_date"], ["_other", "log_date"]
    marked = logs.withColumn("_other", ~is_state)
    cut = is_state & is_splitter(["followup_id"], order, slice_rows)
    sale = marked.groupBy("followup_id").agg(*_bound_columns(is_state, terminal_state),
                                             splitters(order, values, cut).alias("_bounds"))
    # the last state row of an instant by tie-break, NULLs last as in the LEAD's order
    place = F.struct(*[x for c in tiebreak for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))],
                     F.col("updated_content").alias("state"))
    instants = marked.groupBy("followup_id", "log_date").agg(
        F.min("_other").alias("_other"), F.max(F.when(is_state, place)).alias("_last"),
        F.count(F.when(is_state, F.col("updated_content"))).alias("_n_kept"))
    rows = neighbor_in_slices(instants.join(sale, "followup_id"), ["followup_id"], order, values, "next", "next_")
    cap = F.coalesce(F.col("done_at"), F.col("max_log"))
    end = F.coalesce(F.when(~F.col("next__other"), F.col("next_log_date")), F.col("max_log"))
    rows = (rows.withColumn("_on", ~F.col("_other") & (F.col("log_date") <= cap))
            .withColumn("_sec", seconds_between("log_date", F.least(end, cap))))
    return rows.groupBy("followup_id").agg(
        F.max("max_log").alias("max_log"), F.max("first_change").alias("first_change"), F.max("done_at").alias("done_at"),
        F.sum(F.when(F.col("_on"), F.col("_n_kept")).otherwise(F.lit(0))).alias("_kept"),
        *[F.sum(F.when(F.col("_on") & (F.col("_last.state") == s), F.col("_sec")).otherwise(F.lit(0))).alias(f"_s_{s}")
          for s in states])


def state_periods(logs: DataFrame, followups: DataFrame, users: DataFrame, *,
                  state_field: str = "Sector", initial_state: str = "UNDEFINED",
                  terminal_state: str = "COMPLETED", tiebreak: Sequence[str] = ("log_id",),
                  slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """One row per kept period: attributes, state, start, capped end, seconds."""
    tiebreak = list(tiebreak)
    logs = logs.where(F.col("followup_id").isNotNull())
    # one row per sale with its attributes and bounds: joined to the changes, and itself the initial period
    sales = _attributes(followups, users).join(_bounds(logs, state_field, terminal_state), "followup_id")
    changes = _state_rows(logs, state_field, tiebreak, slice_rows).join(sales, "followup_id")
    initial = sales.select("*", F.lit(initial_state).alias("state"), F.col("followup_creation_date").alias("start_time"),
                           F.col("first_change").alias("end_time"))
    return _capped(changes.unionByName(initial)).select(
        "followup_id", *ATTRIBUTES, "state", "start_time", "end_time", "duration_seconds")


def state_durations(logs: DataFrame, followups: DataFrame, users: DataFrame, *,
                    state_field: str = "Sector", initial_state: str = "UNDEFINED",
                    terminal_state: str = "COMPLETED", states: Sequence[str] = tuple(STATES),
                    tiebreak: Sequence[str] = ("log_id",),
                    slice_rows: int = DEFAULT_SLICE_ROWS,
                    assert_users_unique: bool = False) -> DataFrame:
    """One row per sale with ``time_<state>`` seconds for each state.

    ``assert_users_unique`` checks the contract that ``users.user_id`` is a key (D21: a
    duplicate would double every duration) while the users are read; no job runs before.
    """
    if assert_users_unique:
        users = unique_or_fail(users, ["user_id"], "users")
    logs = logs.where(F.col("followup_id").isNotNull())
    per_sale = _per_sale(logs, state_field, terminal_state, states, list(tiebreak), slice_rows)

    # Initial period, one per sale that has any log row.
    cap = F.coalesce(F.col("done_at"), F.col("max_log"))
    start = F.col("followup_creation_date")
    initial_kept = start <= cap
    initial_secs = seconds_between(start, F.least(F.coalesce(F.col("first_change"),
                                                             F.col("max_log")), cap))
    rows = (_attributes(followups, users).join(per_sale, "followup_id")
            .where(initial_kept | (F.coalesce(F.col("_kept"), F.lit(0)) > 0)))

    def total(s: str):
        sector = F.coalesce(F.col(f"_s_{s}"), F.lit(0)).cast("long")
        if s == initial_state:
            sector = sector + F.when(initial_kept, initial_secs).otherwise(F.lit(0))
        return sector.cast("long").alias(f"time_{s.lower()}")

    return rows.select("followup_id", *ATTRIBUTES, *[total(s) for s in states])


def sla_summary(periods: DataFrame, by: Sequence[str] = ("covenant", "state"), *, percents: Sequence[int] = (50, 90, 95),
                per_sale: bool = True, slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """Service levels of the stages: number, average, exact percentiles and maximum of the seconds per ``by``.

    ``periods`` is the output of ``state_periods``.  With ``per_sale`` a sale's periods in one stage count as
    one stay of their total length, else every period counts by itself.  Percentiles are discrete (a duration
    that occurs); see ``functions.carry.quantiles`` for how a stage with most of all rows is handled.
    """
    by = list(by)
    if per_sale:
        keys = list(dict.fromkeys(["followup_id", *by]))
        periods = periods.groupBy(*keys).agg(F.sum("duration_seconds").alias("duration_seconds"))
    return quantiles(periods, by, "duration_seconds", percents, slice_rows=slice_rows)
