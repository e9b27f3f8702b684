"""First vs repeat purchase (V3).

Every completed purchase of a user, labelled 'First-time purchase' for the
chronologically first one and 'Repeat purchase' otherwise.

Semantics:
* purchases: status 'Finalizado', commission >= 0, user id present; seller name by LEFT
  join on seller id;
* the user must exist in ``users`` and have a client id.  Every join multiplies: a
  purchase appears once per user row, client id row and seller row that matches, and the
  ranking is over those rows, so exactly one row per user is the first;
* order: COALESCE(finalized_at, created_at) ascending with NULL last, then followup_id,
  client_key, seller_name and the row's other columns, which makes it total up to copies.

Plan: no user window (a user with a third of all purchases would be sorted in one task).
Copies of purchases, user rows, client ids and seller names are counted by partial
aggregation; the least purchase of a user is a ``min`` of a struct over the filtered
followups alone, the least client key and seller name are taken from their own small
tables, and the row that is least in all three is the first.  The per-user tables meet
before they meet the purchases, sellers are joined once at the end, and AQE splits a hot
partition of either join.  Copies are expanded last, in chunks of ``COPY_CHUNK``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.carry import carry
from flowlens.functions.semantics import is_present, month_start, unique_or_fail
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS

COPY_CHUNK = 1024

FIRST = "First-time purchase"
REPEAT = "Repeat purchase"

OUTPUT_COLUMNS = ["month", "user_id", "client_key", "seller", "platform",
                  "purchase_type", "commission", "completion_date", "creation_date"]


PURCHASE = ["followup_id", "user_id", "seller_id", "origin_platform", "commission", "finalized_at", "created_at"]


def _rank() -> Column:
    """A purchase's place among those of its user; NULLs last."""
    moment = F.coalesce("finalized_at", "created_at")
    rest = [c for c in PURCHASE if c not in ("user_id", "followup_id")]
    return F.struct(moment.isNull().alias("_late"), moment.alias("_moment"), "followup_id",
                    *[x for c in rest for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))])


def _counted(df: DataFrame, keys: list[str], n: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def _completed(followups: DataFrame, done_status: str) -> DataFrame:
    """Completed purchases of a present user."""
    user_type = dict(followups.dtypes)["user_id"]
    present = is_present("user_id") if user_type == "string" else F.col("user_id").isNotNull()
    return followups.where((F.col("status") == done_status) & (F.col("commission") >= 0) & present).select(*PURCHASE)


def first_vs_repeat(followups: DataFrame, operators: DataFrame, users: DataFrame,
                    client_ids: DataFrame, *, done_status: str = "Finalizado",
                    assert_users_unique: bool = False) -> DataFrame:
    """One row per (completed purchase, user row, client id row, seller row) with its type.

    ``assert_users_unique`` checks the key contract of ``users`` instead of multiplying.
    """
    if assert_users_unique:
        users = unique_or_fail(users, ["user_id"], "users")
    purchases = _completed(followups, done_status)

    first = purchases.groupBy("user_id").agg(F.min(_rank()).alias("_first"))
    keys = _counted(client_ids, ["user_id", "client_key"], "_n_keys")
    first_key = keys.groupBy("user_id").agg(F.min(F.struct(F.col("client_key").isNull().alias("_none"), "client_key")).alias("_first_key"))
    people = (_counted(users, ["user_id"], "_n_users").join(first, "user_id").join(first_key, "user_id").join(keys, "user_id")
              .withColumn("_key_first", F.col("client_key").eqNullSafe(F.col("_first_key.client_key"))))
    sellers = _counted(operators, ["seller_id", "seller_name"], "_n_sellers")
    first_seller = sellers.groupBy("seller_id").agg(
        F.min(F.struct(F.col("seller_name").isNull().alias("_none"), "seller_name")).alias("_first_seller"))
    sellers = (sellers.join(first_seller, "seller_id")
               .withColumn("_seller_first", F.col("seller_name").eqNullSafe(F.col("_first_seller.seller_name")))
               .drop("_first_seller"))

    rows = (_counted(purchases, PURCHASE, "_n_rows").join(people, "user_id").join(sellers, "seller_id", "left")
            .withColumn("_copies", F.col("_n_rows") * F.col("_n_users") * F.col("_n_keys") * F.coalesce("_n_sellers", F.lit(1)))
            .withColumn("_is_first", (_rank() == F.col("_first")) & F.col("_key_first") & F.coalesce("_seller_first", F.lit(True))))
    # copies are expanded in chunk rows, so no array is longer than COPY_CHUNK (but for the list of chunks)
    rows = (rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPY_CHUNK))))
            .withColumn("_copy", F.explode(F.sequence(
                F.lit(1).cast("long"), F.least(F.lit(COPY_CHUNK).cast("long"), F.col("_copies") - F.col("_chunk") * COPY_CHUNK)))))
    opens = F.coalesce(F.col("_is_first"), F.lit(False)) & (F.col("_chunk") == 0) & (F.col("_copy") == 1)
    return rows.select(
        F.coalesce(month_start("finalized_at"), month_start("created_at")).alias("month"),
        "user_id",
        "client_key",
        F.col("seller_name").alias("seller"),
        F.col("origin_platform").alias("platform"),
        F.when(opens, F.lit(FIRST)).otherwise(F.lit(REPEAT)).alias("purchase_type"),
        F.col("commission").cast("double").alias("commission"),
        F.col("finalized_at").alias("completion_date"),
        F.col("created_at").alias("creation_date"),
    )


def purchase_numbers(followups: DataFrame, *, done_status: str = "Finalizado", slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """Every completed purchase with its number among its user's and the user's commission up to it.

    The full rank behind ``first_vs_repeat``: ROW_NUMBER and running SUM per user by completion (else creation)
    time, NULLs last, then followup_id.  A user with a third of all purchases is cut into slices that are
    numbered apart (``functions/carry``); copies of a purchase are numbered one after the other.
    """
    rows = _completed(followups, done_status).withColumn("_moment", F.coalesce("finalized_at", "created_at"))
    order = ["_moment", "followup_id", "seller_id", "origin_platform", "commission", "created_at"]
    numbered = carry(rows, ["user_id"], order, rank="purchase_number", sums={"user_commission": "commission"}, slice_rows=slice_rows)
    return numbered.select("user_id", "followup_id", F.col("_moment").alias("completion_date"), "purchase_number",
                           F.col("commission").cast("double").alias("commission"),
                           F.col("user_commission").cast("double").alias("user_commission"))


def purchases_by_number(numbered: DataFrame) -> DataFrame:
    """Purchases, users and commission per purchase number (how many users buy an n-th time)."""
    return numbered.groupBy("purchase_number").agg(F.count(F.lit(1)).alias("users"))
