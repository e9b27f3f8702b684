import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.functions.semantics import (
    day_start,
    first_per_key,
    is_present,
    latest_per_key,
    month_start,
    null_if_zero,
    plus_days,
    running_total,
    seconds_between,
)
from flowlens.functions.sequence import with_neighbor
from tests.conftest import ts


def test_seconds_between_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(ts("2024-03-05 10:00:00.9"), ts("2024-03-05 10:00:01.1"), 1),
         (ts("2024-03-05 10:00:00.1"), ts("2024-03-05 10:00:00.9"), 0),
         (ts("2024-03-05 10:00:01.0"), ts("2024-03-05 10:00:00.0"), -1),
         (ts("1969-12-31 23:59:59.5"), ts("1970-01-01 00:00:00.5"), 1),
         (None, ts("2024-01-01"), None)],
        "a timestamp_ntz, b timestamp_ntz, want int")
    got = df.select(seconds_between("a", "b").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_truncation_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 2018-11-04 00:00 does not exist in Sao Paulo (DST starts at midnight).
        df = spark.createDataFrame([(ts("2018-11-04 00:30:00"),)], "t timestamp_ntz")
        r = df.select(day_start("t").alias("d"), month_start("t").alias("m"),
                      plus_days(day_start("t"), 30).alias("p")).first()
        assert r.d == ts("2018-11-04") and r.m == ts("2018-11-01") and r.p == ts("2018-12-04")
        assert dict(df.select(day_start("t").alias("d")).dtypes)["d"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_seconds_between_is_zone_free_across_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(ts("1995-10-14 12:00:00"), ts("1995-10-15 00:00:00")),    # gap midnight in Sao Paulo
            (ts("1995-10-15 00:00:00"), ts("1995-10-15 10:30:00.5"))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = {}
    for zone in ("UTC", "America/Sao_Paulo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got[zone] = [r.s for r in df.select(seconds_between("a", "b").alias("s")).collect()]
    spark.conf.set("spark.sql.session.timeZone", old)
    assert got["UTC"] == got["America/Sao_Paulo"] == [43200, 37800]


def test_is_present_and_null_if_zero(spark):
    df = spark.createDataFrame([("a", 0), ("", 2), (None, 1)], "s string, n long")
    got = df.select(is_present("s").alias("p"), null_if_zero("n").alias("z")).collect()
    assert [(r.p, r.z) for r in got] == [(True, None), (False, 2), (False, 1)]


def test_running_total_null_month_last(spark):
    df = spark.createDataFrame([(ts("2024-02-01"), 2), (None, 5), (ts("2024-01-01"), 1)],
                               "month timestamp_ntz, n long")
    got = {r.month: r.c for r in running_total(df, "month", "n", "c").collect()}
    assert got == {ts("2024-01-01"): 1, ts("2024-02-01"): 3, None: 8}


def test_first_and_latest_per_key_match_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 5), rnd.choice([None, 1, 2, 3]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, seq int")
    first = first_per_key(df, ["k"], [F.col("t").isNull(), "t", "seq"], ["seq"])
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), "seq")
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("k", "seq")
    assert sorted(first.collect()) == sorted(want.collect())
    latest = latest_per_key(df, ["k"], [F.col("t").isNull(), "t", "seq"], ["seq"])
    w2 = Window.partitionBy("k").orderBy(F.col("t").desc_nulls_first(), F.col("seq").desc())
    want2 = df.withColumn("rn", F.row_number().over(w2)).where("rn = 1").select("k", "seq")
    assert sorted(latest.collect()) == sorted(want2.collect())


def test_with_neighbor_split_path_equals_window(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        key = 0 if i < 400 else rnd.randint(1, 20)          # key 0 is hot
        sec = rnd.randint(0, 5000)
        rows.append((key, sec, i, rnd.choice(["a", "b", None])))
    df = (spark.createDataFrame(rows, "k int, sec int, tb int, v string")
          .withColumn("t", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                      + F.make_dt_interval(secs=F.col("sec")))
          .drop("sec"))
    w = Window.partitionBy("k").orderBy("t", "tb")
    for direction, fn in (("next", F.lead), ("prev", F.lag)):
        want = df.withColumn("n_v", fn("v").over(w)).withColumn("n_tb", fn("tb").over(w))
        for limit in (10 ** 9, 37):  # plain path, then hot keys split in slices
            got = with_neighbor(df, ["k"], ["t", "tb"], ["v", "tb"], direction=direction,
                                prefix="n_", slice_rows=limit)
            assert sorted(got.select("k", "tb", "n_v", "n_tb").collect()) == \
                sorted(want.select("k", "tb", "n_v", "n_tb").collect())


def test_with_neighbor_hot_instant_and_nulls(spark):
    """A hot key with 250 rows at ONE timestamp (sub-sliced by the numeric
    tie-break), NULL timestamps and NULL tie-breaks (both sort last)."""
    rnd = random.Random(3)
    rows, seen = [], set()
    for i in range(700):
        key = 0 if i < 500 else rnd.randint(1, 5)
        if key == 0 and i < 250:
            sec = 777                                       # the hot instant
        elif rnd.random() < 0.03:
            sec = None                                      # NULL time
        else:
            sec = rnd.randint(0, 3000)
        tb = None if rnd.random() < 0.02 else i
        if (key, sec, tb) in seen:
            continue
        seen.add((key, sec, tb))
        rows.append((key, sec, tb, rnd.choice(["a", "b", None])))
    df = (spark.createDataFrame(rows, "k int, sec int, tb int, v string")
          .withColumn("t", F.when(F.col("sec").isNotNull(),
                                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                  + F.make_dt_interval(secs=F.col("sec"))))
          .drop("sec"))
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("tb").asc_nulls_last())
    for direction, fn in (("next", F.lead), ("prev", F.lag)):
        want = sorted(df.select("k", "tb", "t", fn("v").over(w).alias("n_v"),
                                fn("tb").over(w).alias("n_tb")).collect(), key=repr)
        for limit in (10 ** 9, 40, 7):
            got = with_neighbor(df, ["k"], ["t", "tb"], ["v", "tb"], direction=direction,
                                prefix="n_", slice_rows=limit)
            got = sorted(got.select("k", "tb", "t", "n_v", "n_tb").collect(), key=repr)
            assert got == want, (direction, limit)


def _against_window(spark, rows, schema, order, limit, total=None):
    """with_neighbor equals LAG/LEAD; returns the largest slice of the largest key."""
    from flowlens.functions import sequence as S

    df = spark.createDataFrame(rows, schema)
    w = Window.partitionBy("k").orderBy(*[F.col(o).asc_nulls_last() for o in order])
    for direction, fn in (("next", F.lead), ("prev", F.lag)):
        want = sorted(df.select("k", *order, fn("v").over(w).alias("n_v")).collect(), key=repr)
        got = with_neighbor(df, ["k"], order, ["v"], direction=direction, prefix="n_", slice_rows=limit)
        assert sorted(got.select("k", *order, "n_v").collect(), key=repr) == want, direction
    cuts = df.where(S.is_splitter(["k"], order, limit)).groupBy(F.col("k").alias("_k")).agg(
        S.splitters(order, ["v"], F.lit(True)).alias("_bounds"))
    placed = df.join(cuts, F.col("k").eqNullSafe(F.col("_k")), "left")
    before = F.size(F.filter("_bounds", lambda b: b["r"] <= S._rank(order)))
    return placed.groupBy("k", before.alias("s")).count().agg(F.max("count")).first()[0]


def test_slices_follow_the_count_not_the_clock(spark):
    """One row dated 1970 beside a burst, a NULL tie-break and a NULL key group."""
    base = "2024-01-01 00:00:00"
    rows = [(0, base, i, f"v{i}") for i in range(2000)] + [(0, "1970-01-01 00:00:00", 5000, "old"), (0, base, None, "last")]
    rows += [(None, base, i, f"n{i}") for i in range(500)] + [(1, base, 1, "x")]
    rows = [(k, t, b, v) for k, t, b, v in rows]
    assert _against_window(spark, rows, "k int, t string, b long, v string", ["t", "b"], 50) < 600


def test_slices_of_hash_ids_and_string_tie_breaks(spark):
    rnd = random.Random(5)
    ids = [rnd.randrange(-9 * 10 ** 18, 9 * 10 ** 18) for _ in range(1500)] + [9 * 10 ** 18, -9 * 10 ** 18]
    assert _against_window(spark, [(0, 1, i, str(i)) for i in dict.fromkeys(ids)], "k int, t int, b long, v string", ["t", "b"], 40) < 500
    names = [(0, 1, f"name {i * 7919 % 1500:05d}", str(i)) for i in range(1500)] + [(0, 1, None, "none")]
    assert _against_window(spark, names, "k int, t int, b string, v string", ["t", "b"], 40) < 500


def test_null_tie_break_sorts_last_at_every_size(spark):
    """One of two rows of an instant has no id: it is the last one, whatever the slices."""
    import datetime as dt

    from flowlens import state_durations
    from tests.conftest import FOLLOWUPS_SCHEMA, LOGS_SCHEMA, USERS_SCHEMA, followup

    t = lambda h: dt.datetime(2024, 1, 1, h)
    logs = spark.createDataFrame([(1, 1, t(1), "Sector", None, "SALES"), (None, 1, t(1), "Sector", None, "TYPING"),
                                  (3, 1, t(2), "Sector", None, "PROGRESS"), (4, None, t(1), "Sector", None, "SALES")], LOGS_SCHEMA)
    fu = spark.createDataFrame([followup(1, "u", "2024-01-01")], FOLLOWUPS_SCHEMA)
    users = spark.createDataFrame([("u", "A", None, False, None)], USERS_SCHEMA)
    for size in (1, 10 ** 9):
        row = state_durations(logs, fu, users, slice_rows=size).first()
        assert (row.time_sales, row.time_typing) == (0, 3600)
