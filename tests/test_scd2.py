import datetime as dt

from pyspark.sql import functions as F

from scorewatch.functions.timecols import ntz
from scorewatch.operators import scd2

S = "user_id long, score int, updated_at timestamp_ntz"
D = dt.datetime


def _versions(df):
    return sorted((r.user_id, r.score, r.dbt_valid_from, r.dbt_valid_to) for r in df.collect())


def test_snapshot_cases(spark):
    b1 = spark.createDataFrame([
        (1, 500, D(2024, 1, 1)),   # unchanged later
        (2, 600, D(2024, 1, 1)),   # changes
        (3, 700, D(2024, 1, 2)),   # older updated_at arrives: ignored
        (4, 800, D(2024, 1, 1)),   # deleted, then returns
    ], S)
    b2 = spark.createDataFrame([
        (1, 500, D(2024, 1, 1)), (2, 650, D(2024, 1, 3)), (3, 100, D(2024, 1, 1)),
        (5, 400, D(2024, 1, 3)),   # new key
    ], S)
    b3 = spark.createDataFrame([
        (1, 500, D(2024, 1, 1)), (2, 650, D(2024, 1, 3)), (3, 700, D(2024, 1, 2)),
        (4, 810, D(2024, 1, 5)), (5, 400, D(2024, 1, 3)),
    ], S)
    snap = scd2.snapshot_batches([b1, b2, b3], [ntz("2024-01-04 00:00:00"), ntz("2024-01-06 00:00:00")])
    assert _versions(snap) == [
        (1, 500, D(2024, 1, 1), None),
        (2, 600, D(2024, 1, 1), D(2024, 1, 3)),
        (2, 650, D(2024, 1, 3), None),
        (3, 700, D(2024, 1, 2), None),
        (4, 800, D(2024, 1, 1), D(2024, 1, 4)),   # closed at the run time of batch 2
        (4, 810, D(2024, 1, 5), None),            # returned: new version
        (5, 400, D(2024, 1, 3), None),
    ]
    ids = [r.dbt_scd_id for r in snap.collect()]
    assert len(set(ids)) == len(ids)
    assert snap.filter(F.col("dbt_valid_to").isNull()).groupBy("user_id").count().filter("count > 1").count() == 0


def test_scd_id_format(spark):
    row = spark.range(1).select(scd2.scd_id(F.lit(7), ntz("2024-01-01 00:00:00")).alias("h")).first()
    import hashlib
    assert row.h == hashlib.md5(b"7|2024-01-01 00:00:00.000000").hexdigest()


def test_long_fold(spark):
    batches = [spark.createDataFrame([(1, 500 + i, D(2024, 1, 1 + i))], S) for i in range(6)]
    runs = [ntz(f"2024-01-{10 + i:02d} 00:00:00") for i in range(5)]
    snap = scd2.snapshot_batches(batches, runs)
    assert snap.count() == 6 and snap.filter(F.col("dbt_valid_to").isNull()).count() == 1


def test_asof_join_boundaries(spark):
    from scorewatch.operators.asof import asof_join
    versions = spark.createDataFrame([
        (1, "v1", D(2024, 1, 1), D(2024, 1, 3)),
        (1, "v2", D(2024, 1, 3), None),
        (2, "w1", D(2024, 1, 2), D(2024, 1, 4)),      # closed by delete
    ], "user_id long, user_sk string, valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    facts = spark.createDataFrame([
        (10, 1, D(2023, 12, 31)),   # before any version
        (11, 1, D(2024, 1, 1)),     # at valid_from: v1
        (12, 1, D(2024, 1, 3)),     # at valid_to of v1: v2
        (13, 2, D(2024, 1, 4)),     # at delete time: none
        (14, 3, D(2024, 1, 4)),     # unknown user
    ], "tx long, user_id long, created_at timestamp_ntz")
    for strategy in ("merge", "carry"):
        got = {r.tx: r.user_sk for r in asof_join(facts, versions, "user_id", "created_at", select=("user_sk",),
                                                  strategy=strategy).collect()}
        assert got == {10: None, 11: "v1", 12: "v2", 13: None, 14: None}, strategy


def test_snapshot_store_retry_after_failed_write(spark, tmp):
    from scorewatch.plans.pipeline import SnapshotStore, run_snapshot
    store = SnapshotStore(spark, f"{tmp}/snap")
    b1 = spark.createDataFrame([(1, 500, D(2024, 1, 1))], S).withColumnRenamed("score", "scoring")
    assert run_snapshot(store, b1, ntz("2024-01-02 00:00:00")) == 1
    # A failed attempt left an uncommitted v=2 folder behind.
    spark.createDataFrame([(9,)], "junk int").write.parquet(f"{tmp}/snap/v=2")
    assert store.current_version() == 1
    b2 = spark.createDataFrame([(1, 600, D(2024, 1, 3))], S).withColumnRenamed("score", "scoring")
    assert run_snapshot(store, b2, ntz("2024-01-04 00:00:00")) == 2
    assert sorted(r.scoring for r in store.read().collect()) == [500, 600]


def _model(batches, run_times):
    """Timestamp-strategy snapshot, one batch at a time, in plain Python."""
    versions = []          # dicts: user_id, score, valid_from, valid_to
    for i, batch in enumerate(batches):
        open_by_key = {v["user_id"]: v for v in versions if v["valid_to"] is None}
        seen = {}
        for uid, score, ts in batch:
            seen[uid] = (score, ts)
        if i > 0:
            for uid, v in open_by_key.items():
                if uid not in seen:
                    v["valid_to"] = run_times[i - 1]
        for uid, (score, ts) in seen.items():
            cur = open_by_key.get(uid)
            if cur is None:
                versions.append({"user_id": uid, "score": score, "valid_from": ts, "valid_to": None})
            elif ts > cur["valid_from"]:
                cur["valid_to"] = ts
                versions.append({"user_id": uid, "score": score, "valid_from": ts, "valid_to": None})
    return sorted((v["user_id"], v["score"], v["valid_from"], v["valid_to"]) for v in versions)


def test_snapshot_matches_model_on_random_batches(spark):
    import random
    rnd = random.Random(11)
    for _ in range(4):
        n_batches = rnd.randint(2, 4)
        day = [D(2024, 1, 1) + dt.timedelta(hours=h) for h in range(0, 200, 7)]
        batches, last = [], {}
        for b in range(n_batches):
            rows = []
            for uid in range(8):
                if rnd.random() < 0.2:
                    continue                                   # absent: hard delete
                choice = rnd.random()
                if uid in last and choice < 0.4:
                    ts = last[uid]                             # unchanged
                elif uid in last and choice < 0.5:
                    ts = last[uid] - dt.timedelta(hours=1)     # older: ignored
                else:
                    ts = rnd.choice(day) + dt.timedelta(days=30 * b)
                last[uid] = max(ts, last.get(uid, ts))
                rows.append((uid, rnd.randint(300, 850), ts))
            batches.append(rows)
        runs = [D(2024, 1, 1) + dt.timedelta(days=30 * b + 29) for b in range(1, n_batches)]
        frames = [spark.createDataFrame(rows or [(0, 0, None)], S).filter("updated_at is not null")
                  for rows in batches]
        got = scd2.snapshot_batches(frames, [ntz(r.strftime("%Y-%m-%d %H:%M:%S")) for r in runs])
        assert _versions(got) == _model(batches, runs)


def test_null_key_never_matches(spark):
    b1 = spark.createDataFrame([(None, 500, D(2024, 1, 1)), (1, 600, D(2024, 1, 1))], S)
    b2 = spark.createDataFrame([(None, 510, D(2024, 1, 1)), (1, 600, D(2024, 1, 1))], S)
    snap = scd2.snapshot_batches([b1, b2], [ntz("2024-01-05 00:00:00")])
    got = sorted(((r.user_id, r.score, r.dbt_valid_from, r.dbt_valid_to) for r in snap.collect()), key=str)
    assert got == sorted([
        (None, 500, D(2024, 1, 1), D(2024, 1, 5)),   # unmatched: closed as deleted
        (None, 510, D(2024, 1, 1), None),            # and the batch row opens anew
        (1, 600, D(2024, 1, 1), None)], key=str)


def test_asof_strategies_agree_on_random_data(spark):
    import random
    from scorewatch.operators.asof import asof_join
    rnd = random.Random(3)
    versions, sk = [], 0
    for uid in range(6):
        t = D(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(0, 48))
        for _ in range(rnd.randint(0, 6)):
            nxt = t + dt.timedelta(hours=rnd.randrange(1, 60))
            closed = rnd.random() < 0.3
            versions.append((uid, f"s{sk}", t, nxt if closed else None))
            sk += 1
            if not closed:
                t = nxt
                continue
            t = nxt + dt.timedelta(hours=rnd.randrange(0, 10))      # gap after a delete
        # open versions are closed by the next one
    fixed = []
    by_user = {}
    for v in versions:
        by_user.setdefault(v[0], []).append(v)
    for uid, vs in by_user.items():
        vs.sort(key=lambda v: v[2])
        for i, v in enumerate(vs):
            to = v[3] if v[3] is not None else (vs[i + 1][2] if i + 1 < len(vs) else None)
            fixed.append((uid, v[1], v[2], to))
    vdf = spark.createDataFrame(fixed, "user_id long, user_sk string, valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    facts = [(i, rnd.choice([0, 1, 2, 3, 4, 5, 6, None]),
              None if rnd.random() < 0.05 else D(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20)))
             for i in range(400)]
    fdf = spark.createDataFrame(facts, "tx long, user_id long, created_at timestamp_ntz")
    want = {r.tx: r.user_sk for r in asof_join(fdf, vdf, "user_id", "created_at", select=("user_sk",),
                                               strategy="merge").collect()}
    for seconds in (3600, 86_400, 30 * 86_400):
        got = {r.tx: r.user_sk for r in asof_join(fdf, vdf, "user_id", "created_at", select=("user_sk",),
                                                  strategy="carry", bucket_seconds=seconds).collect()}
        assert got == want, seconds
    assert len(want) == 400
