"""V3 first vs repeat and V4 monthly growth on hand-made rows (FIXTURES.md B)."""

from collections import Counter

from flowlens.operators.growth import monthly_growth
from flowlens.operators.purchases import FIRST, REPEAT, first_vs_repeat
from tests.conftest import (
    CONTRACTS_SCHEMA,
    FOLLOWUPS_SCHEMA,
    LEADS_SCHEMA,
    USERS_SCHEMA,
    followup,
    money,
    ts,
)

F_ = "Finalizado"


def test_first_vs_repeat_hand_cases(spark):
    fu = spark.createDataFrame([
        followup(1, "u1", "2024-01-01", "2024-02-01", F_, 10, seller=7),
        followup(2, "u1", "2024-01-15", None, F_, 20, seller=7),       # NULL finalization -> creation
        followup(3, "u1", "2024-01-02", "2024-01-03", "Em andamento", 5),  # not completed
        followup(4, "u1", "2024-01-02", "2024-01-03", F_, -1),          # negative commission
        followup(5, "u1", "2024-01-02", "2024-01-03", F_, None),        # NULL commission
        followup(6, "u1", "2024-02-20", "2024-03-01", F_, 0),           # zero commission kept
        followup(7, "", "2024-01-01", "2024-01-02", F_, 1),             # blank user
        followup(8, None, "2024-01-01", "2024-01-02", F_, 1),           # NULL user
        followup(9, "u2", "2024-01-01", "2024-01-02", F_, 1),           # user not in users
        followup(10, "u3", "2024-01-01", "2024-01-02", F_, 1),          # no client id
        followup(11, "u4", "2024-05-05", "2024-05-06", F_, 3, seller=99),  # seller missing
    ], FOLLOWUPS_SCHEMA)
    ops = spark.createDataFrame([(7, "Seller Seven")], "seller_id long, seller_name string")
    users = spark.createDataFrame([("u1", None, None, None, None), ("u3", None, None, None, None),
                                   ("u4", None, None, None, None)], USERS_SCHEMA)
    ids = spark.createDataFrame([("u1", "ck1"), ("u1", "ck2"), ("u4", "ck4"), ("u4", "ck4")],
                                "user_id string, client_key string")
    out = first_vs_repeat(fu, ops, users, ids)
    rows = Counter((r.user_id, r.client_key, r.creation_date, r.purchase_type, r.seller, r.month)
                   for r in out.collect())
    assert rows == Counter({
        ("u1", "ck1", ts("2024-01-15"), FIRST, "Seller Seven", ts("2024-01-01")): 1,
        ("u1", "ck2", ts("2024-01-15"), REPEAT, "Seller Seven", ts("2024-01-01")): 1,
        ("u1", "ck1", ts("2024-01-01"), REPEAT, "Seller Seven", ts("2024-02-01")): 1,
        ("u1", "ck2", ts("2024-01-01"), REPEAT, "Seller Seven", ts("2024-02-01")): 1,
        ("u1", "ck1", ts("2024-02-20"), REPEAT, None, ts("2024-03-01")): 1,
        ("u1", "ck2", ts("2024-02-20"), REPEAT, None, ts("2024-03-01")): 1,
        ("u4", "ck4", ts("2024-05-05"), FIRST, None, ts("2024-05-01")): 1,
        ("u4", "ck4", ts("2024-05-05"), REPEAT, None, ts("2024-05-01")): 1,
    })
    # invariant: exactly one first-time purchase per user
    firsts = Counter(r.user_id for r in out.collect() if r.purchase_type == FIRST)
    assert set(firsts.values()) == {1}


def test_monthly_growth_hand_cases(spark):
    users = spark.createDataFrame([
        ("a", "COV1", ts("2024-01-10 10:00:00"), False, None),
        ("b", "DESCONHECIDO", ts("2024-01-20"), None, None),   # placeholder covenant
        ("c", "", ts("2024-02-03"), True, None),               # blank covenant, blocked
        ("d", None, ts("2024-03-03"), False, None),            # NULL covenant
        ("e", "COV2", ts("2024-03-09"), False, None),
        ("f", "COV3", None, False, None),                      # NULL creation date
        ("g", "COV4", ts("2023-12-01"), False, None),          # before the cut-off
    ], USERS_SCHEMA)
    lead = lambda user, lid: (user, lid, None, 0, None, None, None, None, None, None, 1)
    leads = spark.createDataFrame([
        lead("a", "L1"), lead("a", "L2"),      # two leads, one user
        lead("c", "L3"),                       # blocked user still counts
        lead("e", None),                       # no lead id: not qualified
        lead("g", "L4"), lead("f", "L5"),
    ], LEADS_SCHEMA)
    contracts = spark.createDataFrame([
        ("k1", ts("2024-01-05"), money(100)), ("k1", ts("2024-01-25"), money(50)),  # 2 in first month
        ("k1", ts("2024-02-05"), money(10)),
        ("k2", None, money(99)),                 # unpaid
        ("k2", ts("2024-02-07"), money(-5)),     # negative
        ("k2", ts("2024-03-01"), money(7)),
        ("", ts("2024-01-01"), money(1000)),     # blank client
    ], CONTRACTS_SCHEMA)
    out = monthly_growth(users, leads, contracts, since="2024-01-01")
    got = {r.month: tuple(r)[1:] for r in out.collect()}
    # month: covenants, users, qualified, clients, clients this month, commission, new, first-commission
    assert got == {
        ts("2024-01-01"): (2, 3, 3, 1, 1, 150.0, 1, 150.0),
        ts("2024-02-01"): (None, 4, 4, None, 1, 10.0, None, None),
        # March has new users but no qualified lead row: dropped by the month filter
    }
    assert out.columns[1:] == ["Total Covenants", "User Base", "Qualified Users", "Total Clients",
                               "Clients This Month", "Commission This Month", "New Clients",
                               "First Purchase Commission"]


def test_first_vs_repeat_many_copies_are_chunked(spark):
    """3,000 identical client-id rows with a chunk of 1,024: exact counts."""
    import flowlens.operators.purchases as P

    fu = spark.createDataFrame([followup(1, "u1", "2024-01-01", "2024-01-02", F_, 1),
                                followup(2, "u1", "2024-02-01", "2024-02-02", F_, 1)],
                               FOLLOWUPS_SCHEMA)
    ops = spark.createDataFrame([], "seller_id long, seller_name string")
    users = spark.createDataFrame([("u1", None, None, None, None)], USERS_SCHEMA)
    ids = spark.range(3000).selectExpr("'u1' AS user_id", "'ck' AS client_key")
    out = P.first_vs_repeat(fu, ops, users, ids)
    got = Counter((r.creation_date, r.purchase_type) for r in out.collect())
    assert got == Counter({(ts("2024-01-01"), FIRST): 1, (ts("2024-01-01"), REPEAT): 2999,
                           (ts("2024-02-01"), REPEAT): 3000})


def test_first_vs_repeat_ranks_after_every_fan_out(spark):
    """Random rows with repeated users, sellers, client ids and purchases: equal to ROW_NUMBER."""
    import random

    import duckdb
    import pandas as pd

    for seed in (1, 2, 3):
        rng = random.Random(seed)
        day = lambda: None if rng.random() < 0.15 else f"2024-01-{rng.randrange(1, 6):02d}"
        sales = [followup(rng.randrange(12), rng.choice(["u1", "u2", "u3", "", None]), day() or "2024-01-03", day(), "Finalizado",
                          rng.choice([1, 1, 2, -1]), seller=rng.choice([1, 2, 9, None]), platform=rng.choice(["APP", "WEB", None]))
                 for _ in range(40)]
        people = [("u1", "A", None, False, None), ("u1", "B", None, False, None), ("u2", "A", None, False, None),
                  ("u4", "A", None, False, None)]
        sellers = [(1, "Ann"), (1, "Bob"), (1, "Bob"), (2, None), (2, "Zoe")]
        ids = [("u1", "K1"), ("u1", "K1"), ("u1", None), ("u2", "K2"), ("u3", "K3")]
        fu = spark.createDataFrame(sales, FOLLOWUPS_SCHEMA)
        got = first_vs_repeat(fu, spark.createDataFrame(sellers, "seller_id long, seller_name string"),
                              spark.createDataFrame(people, USERS_SCHEMA),
                              spark.createDataFrame(ids, "user_id string, client_key string")).toPandas()
        s = fu.toPandas()  # noqa: F841
        p = pd.DataFrame(people, columns=["user_id", "c", "x", "b", "o"])  # noqa: F841
        o = pd.DataFrame({"seller_id": [a for a, _ in sellers], "seller_name": pd.array([b for _, b in sellers], "string")})  # noqa: F841
        i = pd.DataFrame({"user_id": [a for a, _ in ids], "client_key": pd.array([b for _, b in ids], "string")})  # noqa: F841
        want = duckdb.sql("""
            SELECT s.user_id, client_key, seller_name AS seller, origin_platform AS platform, CAST(commission AS DOUBLE) AS commission,
                   finalized_at, s.created_at, row_number() OVER (PARTITION BY s.user_id ORDER BY
                     coalesce(finalized_at, s.created_at) NULLS LAST, followup_id, s.seller_id NULLS LAST,
                     origin_platform NULLS LAST, commission, finalized_at NULLS LAST, s.created_at, client_key NULLS LAST,
                     seller_name NULLS LAST) = 1 AS first
            FROM s JOIN p ON p.user_id = s.user_id JOIN i ON i.user_id = s.user_id LEFT JOIN o ON o.seller_id = s.seller_id
            WHERE commission >= 0 AND s.user_id <> ''""").df()
        key = lambda r: tuple("" if pd.isna(v) else str(v) for v in r)
        a = sorted(key((r.user_id, r.client_key, r.seller, r.platform, r.commission, r.completion_date, r.creation_date,
                        r.purchase_type == FIRST)) for r in got.itertuples())
        b = sorted(key((r.user_id, r.client_key, r.seller, r.platform, r.commission, r.finalized_at, r.created_at, r.first))
                   for r in want.itertuples())
        assert a == b
        assert (got[got.purchase_type == FIRST].groupby("user_id").size() == 1).all()


def test_growth_reads_contracts_once(spark):
    from flowlens.plans.inspect import final_plan

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contracts = spark.range(50).selectExpr("CONCAT('K', id % 7) AS client_key", "CAST('2024-01-01' AS timestamp_ntz) AS paid_at",
                                               "CAST(id AS decimal(18,2)) AS commission")
        from flowlens.operators import growth as V4
        plan = final_plan(V4.client_measures(V4.client_months(contracts)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Range (") == 1
