"""Adapters: driver tables (TPC-H-like star + events) -> logical tables.

The analytics read users, sales ("followups"), change logs, leads, app
events, sellers, client ids and contracts.  The driver data has none of
these, so each logical table is derived, row for row, from whole driver
tables; nothing is sampled or capped, so the work grows with the data.
The DuckDB oracle re-derives the same tables independently in SQL
(``flowlens.plans.oracle``); any rule change must be made in both places.

Column contracts (FIXTURES.md section A):

users          user_id, covenant, created_at, is_blocked, source_platform
followups      followup_id, user_id, created_at, finalized_at, status,
               commission, seller_id, operation, origin_platform,
               destination_bank, cancellation_reason
followup_logs  log_id, followup_id, log_date, changed_field,
               original_content, updated_content   (+ extra tie-break cols)
leads          user_id, lead_id, covenant, link_type, eligible, released,
               has_representative, has_alimony, registry_no, created_at,
               created_seq
events         event_id, user_id, event_at, event_name, platform
operators      seller_id, seller_name
client_ids     user_id, client_key
contracts      client_key, paid_at, commission, contract_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.sources.tables import read_table

MONEY = "decimal(18,2)"

# Fixed values of the adapter rules (shared with the oracle SQL).
SEGMENT_PLATFORM_NULL_MOD = 4          # custkey % 4 = 0 -> NULL source platform
EVENT_FAMILY_CREATED_AT = "2024-01-01 00:00:00"
STAGE_BY_INDEX = ["UNDEFINED", "SALES", "TYPING", "FORMALIZATION",
                  "PROGRESS", "COMPLETED", "CANCELED"]


def _s(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _money(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


# --------------------------------------------------------------------- users
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer.

    covenant: nation name + market segment, with three placeholder cases
    (NULL, blank, 'Desconhecido') picked by custkey % 50; created_at: first
    order date plus custkey % 24 hours (so day truncation matters);
    is_blocked: negative balance; source_platform: NULL for every fourth
    customer, else the segment.
    """
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    o = read_table(spark, sf_dir, "orders")
    first_order = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    key = F.col("c_custkey")
    covenant = (F.when(key % 50 == 0, F.lit(None).cast("string"))
                .when(key % 50 == 1, F.lit(""))
                .when(key % 50 == 2, F.lit("Desconhecido"))
                .otherwise(F.concat_ws(" ", F.col("n_name"), F.col("c_mktsegment"))))
    created = F.col("first_order") + F.make_dt_interval(hours=(key % 24).cast("int"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(first_order, c.c_custkey == first_order.o_custkey, "left")
            .select(_s(key).alias("user_id"),
                    covenant.alias("covenant"),
                    created.alias("created_at"),
                    (F.col("c_acctbal") < 0).alias("is_blocked"),
                    F.when(key % SEGMENT_PLATFORM_NULL_MOD == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("c_mktsegment")).alias("source_platform")))


# ----------------------------------------------------------------- followups
def _order_status(status: Column, priority: Column) -> Column:
    return (F.when(status == "F", F.lit("Finalizado"))
            .when(status == "P",
                  F.when(priority.isin("4-NOT SPECIFIED", "5-LOW"), F.lit("Cancelado"))
                  .otherwise(F.lit("Incompleto em negociação")))
            .otherwise(F.when(priority == "3-MEDIUM", F.lit("Cancelado pelo usuário"))
                       .otherwise(F.lit("Em andamento"))))


def followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order (order family): V3, V5 and the lineitem-log V2."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem")
    last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    okey = F.col("o_orderkey")
    return (o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
            .select(okey.alias("followup_id"),
                    _s("o_custkey").alias("user_id"),
                    F.col("o_orderdate").alias("created_at"),
                    F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("finalized_at"),
                    _order_status(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("status"),
                    (_money("o_totalprice") - F.lit(30000).cast(MONEY)).cast(MONEY).alias("commission"),
                    (F.col("o_custkey") % 200).alias("seller_id"),
                    F.col("o_orderpriority").alias("operation"),
                    F.when(okey % 3 == 0, F.lit("APP")).when(okey % 3 == 1, F.lit("WEB"))
                    .otherwise(F.lit("WHATSAPP")).alias("origin_platform"),
                    F.concat(F.lit("BANK_"), _s(F.col("o_custkey") % 5)).alias("destination_bank"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("no response")).alias("cancellation_reason")))


def customer_followups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per customer, created on one of 30 days from 2024-01-01 (event family: V1, V2)."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(key.alias("followup_id"),
                    _s(key).alias("user_id"),
                    (F.lit(EVENT_FAMILY_CREATED_AT).cast("timestamp_ntz")
                     + F.make_dt_interval(days=(key % 30).cast("int"))).alias("created_at"),
                    F.lit(None).cast("timestamp_ntz").alias("finalized_at"),
                    F.lit("Em andamento").alias("status"),
                    _money("c_acctbal").alias("commission"),
                    F.lit(None).cast("long").alias("seller_id"),
                    F.col("c_mktsegment").alias("operation"),
                    F.lit("APP").alias("origin_platform"),
                    F.concat(F.lit("BANK_"), _s(F.col("c_nationkey") % 5)).alias("destination_bank"),
                    F.lit(None).cast("string").alias("cancellation_reason"))


# ---------------------------------------------------------------------- logs
def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log per customer sale from app events (V1, V2).

    error -> 'Stage Responsible' = 'agent_<event_id % 7>'; the other event
    types are 'Sector' changes: signup SALES, view TYPING, click PROGRESS if
    value > 20 else FORMALIZATION, purchase COMPLETED if value > 60 else
    CANCELED.  original_content = previous value of the same field
    ('UNDEFINED' before the first Sector change, NULL before the first
    responsible).
    """
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    field = (F.when(F.col("event_id") % 11 == 0, F.lit("Comment"))
             .when(et == "error", F.lit("Stage Responsible")).otherwise(F.lit("Sector")))
    value = (F.when(et == "error", F.concat(F.lit("agent_"), _s(F.col("event_id") % 7)))
             .when(et == "signup", F.lit("SALES"))
             .when(et == "view", F.lit("TYPING"))
             .when(et == "click", F.when(F.col("value") > 20, F.lit("PROGRESS"))
                   .otherwise(F.lit("FORMALIZATION")))
             .when(et == "purchase", F.when(F.col("value") > 60, F.lit("COMPLETED"))
                   .otherwise(F.lit("CANCELED"))))
    logs = e.select(F.col("event_id").alias("log_id"),
                    F.col("user_id").alias("followup_id"),
                    F.col("ts").alias("log_date"),
                    field.alias("changed_field"),
                    value.alias("updated_content"))
    # Adapter-side history of the same field (the source system records it).
    # Partitioned by sale only (ordered by field first), so a consumer that
    # windows by sale reuses this hash partitioning instead of re-shuffling.
    w = Window.partitionBy("followup_id").orderBy("changed_field", "log_date", "log_id")
    prev = F.when(F.lag("changed_field").over(w) == F.col("changed_field"),
                  F.lag("updated_content").over(w))
    original = F.when(F.col("changed_field") == "Sector",
                      F.coalesce(prev, F.lit("UNDEFINED"))).otherwise(prev)
    return logs.select("log_id", "followup_id", "log_date", "changed_field",
                       original.alias("original_content"), "updated_content")


def lineitem_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector log per order from its line items (V2 at bench scale).

    Each line item is a 'Sector' change at its ship date; the stage is
    STAGE_BY_INDEX[(linenumber + flag offset) % 7] with offsets R=3, A=1,
    N=0.  Ship dates tie within an order, so the total order is
    (log_date, log_id=linenumber, partkey, suppkey).
    """
    li = read_table(spark, sf_dir, "lineitem")
    offset = (F.when(F.col("l_returnflag") == "R", F.lit(3))
              .when(F.col("l_returnflag") == "A", F.lit(1)).otherwise(F.lit(0)))
    idx = (F.col("l_linenumber") + offset) % 7
    stage = F.element_at(F.array(*[F.lit(s) for s in STAGE_BY_INDEX]), (idx + 1).cast("int"))
    return li.select(F.col("l_linenumber").cast("long").alias("log_id"),
                     F.col("l_partkey").alias("log_part"),
                     F.col("l_suppkey").alias("log_supp"),
                     F.col("l_orderkey").alias("followup_id"),
                     F.col("l_shipdate").alias("log_date"),
                     F.lit("Sector").alias("changed_field"),
                     F.lit(None).cast("string").alias("original_content"),
                     stage.alias("updated_content"))


def status_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of all orders: 'Status' rows of pending ones, 'Sector' rows of the others (V5)."""
    o = read_table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    original = (F.when(okey % 3 == 0, F.lit("Incompleto sem interação"))
                .when(okey % 3 == 1, F.lit("Incompleto em negociação"))
                .otherwise(F.lit("Em análise")))
    updated = (F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), F.lit("Cancelado"))
               .otherwise(F.lit("Incompleto em negociação")))
    return o.select(okey.alias("log_id"), okey.alias("followup_id"),
                    F.col("o_orderdate").alias("log_date"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("Status")).otherwise(F.lit("Sector")).alias("changed_field"),
                    original.alias("original_content"), updated.alias("updated_content"))


# --------------------------------------------------------------------- leads
def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lead row per order, without a lead id unless it is open; flags derived from the order key."""
    o = read_table(spark, sf_dir, "orders")
    okey = F.col("o_orderkey")
    return o.select(
        _s("o_custkey").alias("user_id"),
        F.when((okey % 10 == 0) | (F.col("o_orderstatus") != "O"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("L"), _s(okey))).alias("lead_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("INSS"))
        .otherwise(F.lit("SIAPE")).alias("covenant"),
        F.when(okey % 17 == 0, F.lit(None).cast("int"))
        .otherwise((okey % 3).cast("int")).alias("link_type"),
        (okey % 5 != 0).alias("eligible"),
        F.when(okey % 7 == 0, F.lit(False)).when(okey % 7 == 1, F.lit(None).cast("boolean"))
        .otherwise(F.lit(True)).alias("released"),
        (okey % 11 == 0).alias("has_representative"),
        (okey % 13 == 0).alias("has_alimony"),
        _s(okey % 3).alias("registry_no"),
        F.when(okey % 19 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate")).alias("created_at"),
        okey.alias("created_seq"))


# -------------------------------------------------------------------- events
def proposal_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App events of all orders, at noon of the order day: 'user_has_proposals' for urgent ones."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("event_id"),
                    _s("o_custkey").alias("user_id"),
                    (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(12))).alias("event_at"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("user_has_proposals"))
                    .otherwise(F.lit("opened_app")).alias("event_name"),
                    F.lit("APP").alias("platform"))


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events as app events; platform from the event value (V6)."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id",
                    _s("user_id").alias("user_id"),
                    F.col("ts").alias("event_at"),
                    F.col("event_type").alias("event_name"),
                    F.when(F.col("value") < 50, F.lit("ios")).otherwise(F.lit("android"))
                    .alias("platform"))


def app_events_named(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Driver events renamed by a rule: ``names[event_id % len(names)]``.

    Lets a path graph written for real app event ids (the reference graph)
    run over the whole driver events table.
    """
    e = app_events(spark, sf_dir)
    name = F.element_at(F.array(*[F.lit(n) for n in names]),
                        (F.col("event_id") % len(names) + 1).cast("int"))
    return e.withColumn("event_name", name)


def app_events_walking(spark: SparkSession, sf_dir: str, walks: list[list[str]]) -> DataFrame:
    """Driver events in which every signup walks one way of a path graph.

    A signup becomes the events of ``walks[event_id % len(walks)]``, a minute apart from the signup on; for
    every fifth event id the minutes count backwards and for every seventh all events fall on one minute, so
    strict time order fails.  Other events stay, as 'opened_app'.
    """
    e = read_table(spark, sf_dir, "events")
    number = F.col("event_id")
    ways = F.array(*[F.array(*[F.lit(n) for n in walk]) for walk in walks])
    way = F.when(F.col("event_type") == "signup", F.element_at(ways, (number % len(walks) + 1).cast("int"))).otherwise(
        F.array(F.lit("opened_app")))
    rows = e.select("event_id", "user_id", "ts", "value", F.size(way).alias("n"), F.posexplode(way).alias("i", "event_name"))
    minute = F.when(number % 7 == 0, F.lit(0)).when(number % 5 == 0, F.col("n") - F.col("i")).otherwise(F.col("i"))
    return rows.select((number * 64 + F.col("i")).alias("event_id"), _s("user_id").alias("user_id"),
                       (F.col("ts") + F.make_dt_interval(mins=minute.cast("int"))).alias("event_at"), "event_name",
                       F.when(F.col("value") < 50, F.lit("ios")).otherwise(F.lit("android")).alias("platform"))


# ---------------------------------------------------- sellers, ids, contracts
def operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"))


def client_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opaque client key per user (NULL without a balance); high-balance customers have a second one."""
    c = read_table(spark, sf_dir, "customer")
    key = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("CK"), _s("c_custkey")))
    first = c.select(_s("c_custkey").alias("user_id"), key.alias("client_key"))
    second = (c.where(F.col("c_acctbal") > 9000)
              .select(_s("c_custkey").alias("user_id"),
                      F.concat(key, F.lit("-B")).alias("client_key")))
    return first.unionByName(second)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per order; unpaid when pending; commission = price - 50,000."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_custkey") % 50 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("CK"), _s("o_custkey"))).alias("client_key"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.col("o_orderdate")).alias("paid_at"),
        (_money("o_totalprice") - F.lit(50000).cast(MONEY)).cast(MONEY).alias("commission"),
        F.col("o_orderkey").alias("contract_id"))
