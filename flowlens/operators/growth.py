"""Monthly growth KPIs on a month spine (V4).

Per month: cumulative covenants, users, qualified leads and clients; unique
paying clients and their commission; new clients and the commission of
clients in their first paying month.

Reference semantics kept (SURVEY 2.4, D12-D15):
* covenants: present and not ILIKE 'desconhecido'; months = first month;
* qualified leads: DISTINCT (user, lead, created, blocked flag) rows of
  users joined to leads with a lead id, counted per user-creation month
  (blocked users count: the flag is never NULL after the default);
* clients: present client key, paid, commission >= 0; first-purchase
  commission sums *all* contracts in the client's first paying month;
* spine = months in which new users appear; every other table is LEFT
  joined by month (a month without new covenants has NULL "Total
  Covenants": no carry-forward); the final month filter is on the
  qualified-leads month, which turns that join into an inner one;
* running sums order months ascending with NULL months last.

Plan: every per-entity step is an aggregation (partial aggregation handles a
hot client or user), and contracts are scanned once and reduced to (client,
month) sums, from which one window over a client's own months gives all four
client measures.  Only month-grain tables (at most a few
hundred rows) reach the running-sum windows and the spine joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.carry import carry
from flowlens.functions.semantics import is_present, month_start, running_total
from flowlens.functions.sequence import DEFAULT_SLICE_ROWS

SINCE = "2022-01-01"
UNKNOWN_COVENANT = "desconhecido"

OUTPUT_COLUMNS = ["month", "Total Covenants", "User Base", "Qualified Users", "Total Clients",
                  "Clients This Month", "Commission This Month", "New Clients",
                  "First Purchase Commission"]


def _counts_by_first_month(firsts: DataFrame, entity: str, out: str) -> DataFrame:
    """COUNT(entity) per first month plus its running total."""
    per_month = firsts.groupBy("month").agg(F.count(entity).alias(out))
    return running_total(per_month, "month", out, "cumulative")


def first_appearance_month(df: DataFrame, entity: str, ts: str) -> DataFrame:
    """MIN(DATE_TRUNC('month', ts)) per present entity."""
    return (df.where(is_present(entity))
            .groupBy(entity).agg(F.min(month_start(ts)).alias("month")))


def new_users(users: DataFrame) -> DataFrame:
    """New users per first month and their running total (the month spine)."""
    firsts = first_appearance_month(users, "user_id", "created_at")
    return _counts_by_first_month(firsts, "user_id", "new_users")


def new_covenants(users: DataFrame, unknown: str = UNKNOWN_COVENANT) -> DataFrame:
    valid = users.where(is_present("covenant") & ~F.col("covenant").ilike(unknown))
    firsts = valid.groupBy("covenant").agg(F.min(month_start("created_at")).alias("month"))
    return _counts_by_first_month(firsts, "covenant", "new_covenants")


def qualified_leads(users: DataFrame, leads: DataFrame) -> DataFrame:
    """Qualified lead rows per user-creation month and their running total.

    Equal to COUNT(*) over DISTINCT (user_id, lead_id, created_at, blocked)
    with a lead id: distinct user rows times distinct lead ids of the user,
    computed as one count per user (a user with many leads is one row).
    """
    user_rows = (users.select("user_id", "created_at",
                              F.coalesce(F.col("is_blocked"), F.lit(False)).alias("_blocked"))
                 .distinct())
    lead_counts = (leads.where(F.col("lead_id").isNotNull())
                   .select("user_id", "lead_id").distinct()
                   .groupBy("user_id").agg(F.count(F.lit(1)).alias("_leads")))
    per_month = (user_rows.join(lead_counts, "user_id")
                 .groupBy(month_start("created_at").alias("month"))
                 .agg(F.sum("_leads").cast("long").alias("users")))
    return running_total(per_month, "month", "users", "cumulative")


def client_months(contracts: DataFrame) -> DataFrame:
    """Valid contracts reduced to one row per (client, paying month)."""
    valid = contracts.where(is_present("client_key") & F.col("paid_at").isNotNull()
                            & (F.col("commission") >= 0))
    return (valid.groupBy("client_key", month_start("paid_at").alias("month"))
            .agg(F.sum("commission").alias("commission")))


def monthly_clients(cm: DataFrame) -> DataFrame:
    """COUNT(DISTINCT client) and SUM(commission) per paying month."""
    return cm.groupBy("month").agg(F.count(F.lit(1)).alias("unique_clients"),
                                   F.sum("commission").alias("total_commission"))


def first_month_commission(cm: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new clients per first month with running total, first-month commission).

    ``cm`` has one row per (client, month), so the least (month, commission) of a client
    is its first month together with that month's commission: one aggregation, no join.
    """
    per_month = opening_months(cm)
    new = running_total(per_month.select("month", "new_clients"), "month", "new_clients", "cumulative")
    return new, per_month.select("month", "first_purchase_commission")


def opening_months(cm: DataFrame) -> DataFrame:
    """Clients and commission per first paying month."""
    first = cm.groupBy("client_key").agg(F.min(F.struct("month", "commission")).alias("first"))
    return first.groupBy(F.col("first.month").alias("month")).agg(
        F.count("client_key").alias("new_clients"), F.sum("first.commission").alias("first_purchase_commission"))


def client_measures(cm: DataFrame) -> DataFrame:
    """All four client measures per month from one pass over (client, month) rows.

    A client's months are put beside its first one by a window over the client's own few
    rows; every measure is then a conditional sum per month.
    """
    own = Window.partitionBy("client_key")
    opens = F.col("month") == F.min("month").over(own)
    per_month = (cm.withColumn("_opens", opens).groupBy("month").agg(
        F.count(F.lit(1)).alias("unique_clients"), F.sum("commission").alias("total_commission"),
        F.count_if("_opens").alias("new_clients"),
        F.sum(F.when(F.col("_opens"), F.col("commission"))).alias("first_purchase_commission")))
    opened = per_month.withColumn("new_clients", F.when(F.col("new_clients") > 0, F.col("new_clients")))
    # the running number belongs to months with new clients only
    total = F.sum("new_clients").over(Window.orderBy(F.col("month").asc_nulls_last()))
    return opened.withColumn("_clients", F.when(F.col("new_clients").isNotNull(), total))


def monthly_growth(users: DataFrame, leads: DataFrame, contracts: DataFrame, *,
                   since: str | None = SINCE, unknown_covenant: str = UNKNOWN_COVENANT,
                   dense: bool = False) -> DataFrame:
    """The KPIs per month.

    By default the spine is the source's: months with new users and qualified leads, NULL where a table has no
    row.  With ``dense`` every calendar month from the first to the last of any table has a row: cumulative
    columns carry the last value on, the others stay NULL in a month without rows; ``since`` filters the month.
    """
    spine = new_users(users).select("month", F.col("cumulative").alias("_users"))
    cov = new_covenants(users, unknown_covenant).select("month", F.col("cumulative").alias("_cov"))
    qual = qualified_leads(users, leads).select(F.col("month").alias("_qmonth"),
                                                F.col("cumulative").alias("_qual"))
    clients = client_measures(client_months(contracts))
    if dense:
        return _growth_columns(_dense(spine, cov, qual.withColumn("month", F.col("_qmonth")), clients, since))

    out = (spine.join(cov, "month", "left")
           .join(qual, F.col("month") == F.col("_qmonth"), "left")
           .join(clients, "month", "left"))
    if since is not None:
        out = out.where(F.col("_qmonth") >= F.lit(since).cast("timestamp_ntz"))
    return _growth_columns(out)


def _dense(spine: DataFrame, cov: DataFrame, qual: DataFrame, clients: DataFrame, since: str | None) -> DataFrame:
    """All four tables on a calendar without holes; a table of months, so one small window carries the values."""
    months = reduce(DataFrame.unionByName, [t.select("month") for t in (spine, cov, qual, clients)])
    ends = months.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).where("lo IS NOT NULL")
    days = ends.select(F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"), F.expr("INTERVAL 1 MONTH"))).alias("day"))
    calendar = days.select(F.col("day").cast("timestamp_ntz").alias("month"))
    found = calendar
    for table in (spine, cov, qual.drop("_qmonth"), clients):
        found = found.join(table, "month", "left")
    running = ["_users", "_cov", "_qual", "_clients"]
    filled = carry(found, [], ["month"], known={f"{c}_on": F.col(c) for c in running}, period=F.year("month"))
    out = filled.withColumns({c: F.col(f"{c}_on") for c in running}).withColumn("_qmonth", F.col("month"))
    return out if since is None else out.where(F.col("month") >= F.lit(since).cast("timestamp_ntz"))


def _growth_columns(out: DataFrame) -> DataFrame:
    return out.select(
        F.col("_qmonth").alias("month"),
        F.col("_cov").alias("Total Covenants"),
        F.col("_users").alias("User Base"),
        F.col("_qual").alias("Qualified Users"),
        F.col("_clients").alias("Total Clients"),
        F.col("unique_clients").alias("Clients This Month"),
        F.col("total_commission").cast("double").alias("Commission This Month"),
        F.col("new_clients").alias("New Clients"),
        F.col("first_purchase_commission").cast("double").alias("First Purchase Commission"),
    )


def cumulative_commission(contracts: DataFrame, *, order: Sequence[str] = ("paid_at", "contract_id"),
                          slice_rows: int = DEFAULT_SLICE_ROWS) -> DataFrame:
    """Every valid paid contract with the company's and its client's commission up to it.

    Running sums over contracts, not months: the company's has no key, so it is cut at the days of payment (and
    inside a day at splitters), and only a row per day meets in one task; the client's is cut the same
    way where a client has very many contracts.
    """
    order = list(order)
    valid = contracts.where(is_present("client_key") & F.col("paid_at").isNotNull() & (F.col("commission") >= 0)).select(
        "client_key", "commission", *order)
    total = carry(valid, [], order, rank="contract_number", sums={"_total": "commission"}, period=F.to_date("paid_at"), slice_rows=slice_rows)
    both = carry(total, ["client_key"], order, sums={"_client": "commission"}, slice_rows=slice_rows)
    return both.select(*order, "client_key", F.col("commission").cast("double").alias("commission"), "contract_number",
                       F.col("_total").cast("double").alias("cumulative_commission"),
                       F.col("_client").cast("double").alias("client_commission"))
