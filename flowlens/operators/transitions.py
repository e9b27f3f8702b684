"""Who was responsible at each stage change, and was it a forward step (V1).

For each sale created on or after ``since``, its log rows of the stage field
and the responsible field are put in time order.  A stage-change row is kept
when the row just before it (stage or responsible, any kind) held a value
that is not a stage name: that value is the *responsible* for the change.
``is_conversion`` is 1 when (original, updated) is one of the forward steps.

Reference semantics kept (SURVEY 2.1):
* the field filter runs *before* the LAG, so LAG only sees the two kinds;
* a previous value that is a stage name becomes '' and the row is dropped;
  the first row (NULL previous) is dropped too;
* the previous row's field is not checked (D8); a stage value outside the
  stage list leaks as a responsible, exactly as in the reference;
* the reference orders by log time only; ``tiebreak`` makes it total.

Plan: field filter pushed to the scan; only the log of sales created since the
cutoff goes on; skew-safe LAG per sale; keep filter; attributes are joined once, to
the kept rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.carry import carry
from flowlens.functions.semantics import unique_or_fail
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS, with_neighbor

# Fixed values of the reference: the seven stage names and the five
# forward steps UNDEFINED -> SALES -> TYPING -> FORMALIZATION -> PROGRESS
# -> COMPLETED.
STAGE_NAMES = ["UNDEFINED", "CANCELED", "SALES", "TYPING", "FORMALIZATION", "PROGRESS", "COMPLETED"]
FORWARD_STEPS = [("UNDEFINED", "SALES"), ("SALES", "TYPING"), ("TYPING", "FORMALIZATION"),
                 ("FORMALIZATION", "PROGRESS"), ("PROGRESS", "COMPLETED")]
SINCE = "2024-08-01"

OUTPUT_COLUMNS = ["followup_id", "user_id", "covenant", "operation", "destination_bank",
                  "origin_platform", "followup_creation_date", "log_date", "original_content",
                  "updated_content", "stage_responsible", "is_conversion", "cancellation_reason"]


def stage_responsible(logs: DataFrame, followups: DataFrame, users: DataFrame, *,
                      stage_field: str = "Sector",
                      responsible_field: str = "Stage Responsible",
                      stage_names: Sequence[str] = tuple(STAGE_NAMES),
                      forward_steps: Sequence[tuple[str, str]] = tuple(FORWARD_STEPS),
                      since: str | None = SINCE, tiebreak: Sequence[str] = ("log_id",),
                      slice_rows: int = DEFAULT_SLICE_ROWS,
                      assert_users_unique: bool = False) -> DataFrame:
    """Kept stage changes with their responsible and the forward-step flag."""
    if assert_users_unique:
        users = unique_or_fail(users, ["user_id"], "users")
    tiebreak = list(tiebreak)
    rows = (logs.where(F.col("changed_field").isin(stage_field, responsible_field))
            .select("followup_id", "log_date", *tiebreak, "changed_field",
                    "original_content", "updated_content"))
    sales = followups
    if since is not None:
        sales = sales.where(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
        # LAG never crosses sales: the log of older ones is dropped before anything is ordered
        rows = rows.join(sales.select("followup_id"), "followup_id", "left_semi")
    attrs = (sales.join(users.select("user_id", "covenant"), "user_id")
             .select("followup_id", "user_id", "covenant", "operation", "destination_bank",
                     "origin_platform", F.col("created_at").alias("followup_creation_date"),
                     "cancellation_reason"))
    rows = with_neighbor(rows.where(F.col("followup_id").isNotNull()), ["followup_id"], ["log_date", *tiebreak],
                         ["updated_content"], direction="prev", prefix="prev_", slice_rows=slice_rows, null_keys=False)
    prev = F.col("prev_updated_content")
    responsible = F.when(prev.isin(*stage_names), F.lit("")).otherwise(prev)
    kept = (rows.withColumn("stage_responsible", responsible)
            .where((F.col("changed_field") == stage_field) & (F.col("stage_responsible") != "")))

    forward = reduce(lambda a, b: a | b,
                     [(F.col("original_content") == a) & (F.col("updated_content") == b)
                      for a, b in forward_steps], F.lit(False))
    return (kept.join(attrs, "followup_id")
            .select("followup_id", "user_id", "covenant", "operation", "destination_bank",
                    "origin_platform", "followup_creation_date", "log_date",
                    "original_content", "updated_content", "stage_responsible",
                    F.when(forward, F.lit(1)).otherwise(F.lit(0)).alias("is_conversion"),
                    "cancellation_reason"))


def forward_conversions(responsible_rows: DataFrame) -> DataFrame:
    """Kept stage changes and forward steps per responsible (accountability report)."""
    return responsible_rows.groupBy("stage_responsible").agg(
        F.count(F.lit(1)).alias("stage_changes"),
        F.sum("is_conversion").cast("long").alias("conversions"))


def responsible_as_of(logs: DataFrame, followups: DataFrame, users: DataFrame, *,
                      stage_field: str = "Sector", responsible_field: str = "Stage Responsible",
                      forward_steps: Sequence[tuple[str, str]] = tuple(FORWARD_STEPS),
                      since: str | None = SINCE, tiebreak: Sequence[str] = ("log_id",),
                      slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """Every stage change with the responsible in office: the last one named at or before it.

    ``stage_responsible`` looks at the row just before a change only (D8), so it loses the changes that follow
    another change.  Here each change of a sale created since the cut-off stays, with the newest
    non-null responsible at or before its time (``responsible_since`` is when that was set; both NULL
    if none was), by ``tiebreak`` among equal times; a responsible set at the same instant counts.

    Plan: the log is cut to the two fields and the recent sales before anything is ordered; the last
    known value is carried along a sale's rows by ``functions/carry``, across slices of a hot sale; attributes are
    joined once.
    """
    tiebreak = list(tiebreak)
    sales = followups if since is None else followups.where(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
    attrs = (sales.join(users.select("user_id", "covenant"), "user_id")
             .select("followup_id", "user_id", "covenant", "operation", F.col("created_at").alias("followup_creation_date")))
    rows = (logs.where(F.col("changed_field").isin(stage_field, responsible_field) & F.col("followup_id").isNotNull())
            .select("followup_id", "log_date", *tiebreak, "changed_field", "original_content", "updated_content")
            .join(sales.select("followup_id"), "followup_id", "left_semi")
            .withColumn("_change", (F.col("changed_field") == stage_field).cast("int")))
    named = F.when((F.col("_change") == 0) & F.col("updated_content").isNotNull(),
                   F.struct(F.col("updated_content").alias("name"), F.col("log_date").alias("at")))
    known = carry(rows, ["followup_id"], ["log_date", "_change", *tiebreak], known={"_in_office": named}, slice_rows=slice_rows)
    forward = reduce(lambda a, b: a | b, [(F.col("original_content") == a) & (F.col("updated_content") == b)
                                          for a, b in forward_steps], F.lit(False))
    return (known.where("_change = 1").join(attrs, "followup_id")
            .select("followup_id", "user_id", "covenant", "operation", "followup_creation_date", "log_date", *tiebreak,
                    "original_content", "updated_content", F.col("_in_office.name").alias("stage_responsible"),
                    F.col("_in_office.at").alias("responsible_since"),
                    F.when(forward, F.lit(1)).otherwise(F.lit(0)).alias("is_conversion")))
