import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import types as T

from scorewatch.operators.velocity import with_velocity

SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("amount_usd", T.DecimalType(15, 2))])

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = with_velocity(df, **kw).collect()
    return {r["transaction_id"]: r for r in out}


def test_left_open_window_edges(spark):
    rows = [
        (1, 7, T0, Decimal("10.00")),
        (2, 7, T0 + dt.timedelta(minutes=5), Decimal("1.00")),                      # exactly 5 min: 1 not counted
        (3, 7, T0 + dt.timedelta(minutes=10) - dt.timedelta(microseconds=1), Decimal("2.00")),
        (4, 7, T0 + dt.timedelta(minutes=15) - dt.timedelta(microseconds=2), Decimal("3.00")),
    ]
    r = _run(spark, rows)
    assert r[1]["cnt_5min"] == 1 and r[1]["sum_5min"] == Decimal("10.00")
    assert r[2]["cnt_5min"] == 1                      # row 1 is exactly 5 minutes back: excluded
    assert r[3]["cnt_5min"] == 2                      # row 2 is 5 min - 1 µs back: included
    assert r[4]["cnt_15min"] == 4 and r[4]["sum_15min"] == Decimal("16.00")


def test_equal_timestamps_are_peers(spark):
    rows = [(1, 1, T0, Decimal("1.00")), (2, 1, T0, Decimal("2.00")), (3, 1, T0, None)]
    r = _run(spark, rows)
    assert {r[i]["cnt_5min"] for i in (1, 2, 3)} == {3}
    assert r[3]["sum_5min"] == Decimal("3.00")


def test_null_user_and_time_get_zero(spark):
    rows = [(1, None, T0, Decimal("5.00")), (2, None, T0, Decimal("5.00")),
            (3, 4, None, Decimal("5.00")), (4, 4, T0, Decimal("5.00"))]
    r = _run(spark, rows)
    for i in (1, 2, 3):
        assert r[i]["cnt_60min"] == 0 and r[i]["sum_60min"] == Decimal("0.00")
    assert r[4]["cnt_60min"] == 1


def _brute(rows, w_min):
    out = {}
    for tid, uid, t, a in rows:
        if uid is None or t is None:
            out[tid] = (0, Decimal("0"))
            continue
        lo = t - dt.timedelta(minutes=w_min)
        peers = [x for x in rows if x[1] == uid and x[2] is not None and lo < x[2] <= t]
        out[tid] = (len(peers), sum((x[3] or Decimal("0") for x in peers), Decimal("0")))
    return out


def test_bucketed_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        uid = rnd.choice([1, 1, 1, 2, 3, None])      # user 1 is hot
        t = T0 + dt.timedelta(microseconds=rnd.randrange(0, 3 * 3600 * 10**6))
        if rnd.random() < 0.05:
            t = T0 + dt.timedelta(minutes=rnd.randrange(0, 180))   # whole minutes: edge ties
        rows.append((i, uid, t, Decimal(rnd.randrange(0, 100000)) / 100))
    for bucket in (1, 7, 60, 240):
        r = _run(spark, rows, bucket_minutes=bucket)
        for w in (5, 15, 60):
            exp = _brute(rows, w)
            for tid, (c, s) in exp.items():
                assert r[tid][f"cnt_{w}min"] == c, (bucket, w, tid)
                assert r[tid][f"sum_{w}min"] == s, (bucket, w, tid)


def test_one_exchange_for_all_windows(spark):
    df = spark.createDataFrame([(1, 1, T0, Decimal("1.00"))], SCHEMA)
    plan = with_velocity(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_probe_strategy_matches_brute_force(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(500):
        uid = rnd.choice([1, 1, 1, 2, 3, None])
        t = T0 + dt.timedelta(microseconds=rnd.randrange(0, 2 * 3600 * 10**6))
        if rnd.random() < 0.1:
            t = T0 + dt.timedelta(minutes=rnd.randrange(0, 120))
        if rnd.random() < 0.03:
            t = None
        amount = None if rnd.random() < 0.05 else Decimal(rnd.randrange(0, 100000)) / 100
        rows.append((i, uid, t, amount))
    for seconds in (1, 45, 600, 7200):
        r = _run(spark, rows, strategy="probe", bucket_seconds=seconds)
        assert len(r) == len(rows)
        for w in (5, 15, 60):
            for tid, (c, s) in _brute(rows, w).items():
                assert r[tid][f"cnt_{w}min"] == c, (seconds, w, tid)
                assert r[tid][f"sum_{w}min"] == s, (seconds, w, tid)


def test_probe_strategy_edges(spark):
    rows = [
        (1, 7, T0, Decimal("10.00")),
        (2, 7, T0 + dt.timedelta(minutes=5), Decimal("1.00")),
        (3, 7, T0 + dt.timedelta(minutes=10) - dt.timedelta(microseconds=1), Decimal("2.00")),
        (4, 7, T0 + dt.timedelta(minutes=10) - dt.timedelta(microseconds=1), Decimal("3.00")),
    ]
    r = _run(spark, rows, strategy="probe", bucket_seconds=1)
    assert [r[i]["cnt_5min"] for i in (1, 2, 3, 4)] == [1, 1, 3, 3]
    assert r[3]["sum_5min"] == Decimal("6.00")


def test_auto_buckets_choose_and_stay_exact(spark):
    from scorewatch.operators.velocity import choose_buckets
    rows = [(i, 1 if i % 2 else 2, T0 + dt.timedelta(seconds=3 * i), Decimal("1.00")) for i in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA)
    # 600 rows of user 1 in one hour: 10 per minute.
    assert choose_buckets(df, "user_id", "created_at", 60, target_rows=6000) == {
        "strategy": "halo", "bucket_minutes": 600}
    assert choose_buckets(df, "user_id", "created_at", 60, target_rows=100) == {
        "strategy": "probe", "bucket_seconds": 600}
    for target in (6000, 100):
        r = _run(spark, rows, bucket_minutes="auto", target_rows_per_task=target)
        for w in (5, 60):
            for tid, (c, s) in _brute(rows, w).items():
                assert (r[tid][f"cnt_{w}min"], r[tid][f"sum_{w}min"]) == (c, s), (target, w, tid)


def test_auto_buckets_on_empty_input(spark):
    from scorewatch.operators.velocity import choose_buckets
    empty = spark.createDataFrame([(1, None, None, Decimal("1.00"))], SCHEMA)
    assert choose_buckets(empty, "user_id", "created_at", 60) == {"strategy": "halo", "bucket_minutes": 1440}
    r = _run(spark, [(1, None, None, Decimal("1.00"))], bucket_minutes="auto")
    assert r[1]["cnt_60min"] == 0


def test_instants_strategy_matches_brute_force(spark):
    rng = random.Random(23)
    rows = [(i, rng.choice([1, 1, 2, None]),
             None if rng.random() < 0.05 else T0 + dt.timedelta(minutes=rng.choice([0, 0, 5, 14, 15, 60, 61, 130])),
             None if rng.random() < 0.1 else Decimal(rng.randrange(10_000)) / 100) for i in range(300)]
    for target in (7, 10_000):
        r = _run(spark, rows, strategy="instants", target_rows_per_task=target)
        assert len(r) == 300
        for w in (5, 15, 60):
            for tid, (n, s) in _brute(rows, w).items():
                assert (r[tid][f"cnt_{w}min"], r[tid][f"sum_{w}min"]) == (n, s), (target, w, tid)


def test_one_instant_with_a_third_of_all_rows(spark):
    """100,000 rows of one user at one instant: no window group and no join
    key holds more than a bounded number of them."""
    from pyspark.sql import functions as F

    from scorewatch.operators.velocity import choose_buckets, deal_out
    df = spark.range(300_000).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("long").alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(F.timestamp_add("SECOND", (F.col("id") % 7200).cast("int"), F.lit(T0)))
        .cast("timestamp_ntz").alias("created_at"), F.lit(1).cast("decimal(15,2)").alias("amount_usd"))
    target = 4000
    chosen = choose_buckets(df, "user_id", "created_at", 60, target_rows=target)
    assert chosen == {"strategy": "instants", "target_rows_per_task": target}
    instants = df.groupBy(F.col("user_id").alias("_iu"), F.col("created_at").alias("_it")).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("amount_usd").alias("s")).alias("_w"))
    assert instants.agg(F.max("_w.n")).first()[0] >= 100_000
    largest = (deal_out(df, instants, "user_id", "created_at", target)
               .groupBy("user_id", "created_at", "_s").count().agg(F.max("count")).first()[0])
    assert largest < 1.2 * target
    assert instants.groupBy("_iu").count().agg(F.max("count")).first()[0] < target * 2  # what the windows run over
    hot = with_velocity(df, bucket_minutes="auto", target_rows_per_task=target).filter(F.col("created_at") == F.lit(T0))
    got = hot.filter("user_id = 1").agg(F.count("*"), F.min("cnt_5min"), F.max("cnt_60min"), F.max("sum_5min")).first()
    at_t0 = df.filter((F.col("user_id") == 1) & (F.col("created_at") == F.lit(T0))).count()
    assert tuple(got) == (at_t0, at_t0, at_t0, at_t0)


def test_days_one_by_one_equal_the_whole_table(spark):
    from pyspark.sql import functions as F

    from scorewatch.operators.velocity import user_transaction_velocity, velocity_for_dates
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 2, 3, None]), None if i % 40 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(
        days=rng.randrange(5), minutes=rng.choice([0, 1, 30, 59, 700, 1381, 1400, 1439]), microseconds=rng.randrange(2)), Decimal(i))
        for i in range(500)]
    tx = spark.createDataFrame(rows, SCHEMA).withColumn("event_date", F.to_date("created_at"))
    full = [tuple(r) for r in user_transaction_velocity(tx).withColumn("event_date", F.to_date("created_at")).collect()]
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    folded = [tuple(r) for d in [*days, None] for r in velocity_for_dates(tx, [d]).collect()]
    assert sorted(folded, key=str) == sorted(full, key=str)
    got = [r for r in folded if r[-1]]
    some = [days[0], days[2], days[3]]
    assert sorted((tuple(r) for r in velocity_for_dates(tx, some).collect()), key=str) == sorted((r for r in got if r[-1] in some), key=str)
    wide = velocity_for_dates(tx, [days[4]], windows_min=(2000,))  # reaches back two days
    full = {r.transaction_id: r.cnt_2000min for r in user_transaction_velocity(tx, windows_min=(2000,)).collect()}
    assert all(full[r.transaction_id] == r.cnt_2000min for r in wide.collect())
