"""The append-only snapshot: equal to the one-pass snapshot, small steps, bounded lookups."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from scorewatch.functions.timecols import ntz
from scorewatch.operators import scd2
from scorewatch.plans.snapshot_log import SnapshotLog

S = "user_id long, score int, updated_at timestamp_ntz"
D = dt.datetime


def rows(df):
    return sorted((str(r.user_id), r.score, r.dbt_scd_id, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in df.collect())


def data_files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/**/*.parquet", recursive=True) if "_parts" not in f}


def files_read(df):
    """Parquet files that the scans of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numFiles").get().value() for i in range(leaves.size())
               if leaves.apply(i).metrics().contains("numFiles"))


def test_twenty_random_batches(spark, tmp):
    rng = random.Random(11)
    log = SnapshotLog(spark, f"{tmp}/snap", buckets=8)
    state, batches, runs = {}, [], []
    for i in range(20):
        for _ in range(rng.randrange(4)):
            u = rng.choice([None, *range(25)])
            if rng.random() < 0.3:
                state.pop(u, None)
            else:  # sometimes an older time than the open version's
                state[u] = (rng.randrange(300, 850), D(2024, 1, 1) + dt.timedelta(hours=rng.randrange(20 * i, 24 * (i + 1))))
        batches.append(spark.createDataFrame([(u, *v) for u, v in state.items()], S).coalesce(1))
        runs.append(ntz(f"2024-06-{i + 1:02d} 00:00:00"))
        log.step(batches[-1], runs[-1])
        if i in (7, 13):
            log.compact()
        if i in (3, 8):
            want = scd2.snapshot_batches(batches, runs[1:])
            assert rows(log.read()) == rows(want), i
    assert log.version() == 20
    want = rows(scd2.snapshot_batches(batches, runs[1:]))
    for users in ([3], [1, 7, 24], [999], []):
        assert rows(log.of_users(users)) == [r for r in want if r[0] in map(str, users)]
        assert rows(log.of_users(users, history=False)) == [r for r in want if r[0] in map(str, users) and r[4] == "None"]
    again = SnapshotLog(spark, f"{tmp}/snap", buckets=3)  # the table's own number of buckets holds
    assert again.buckets == 8 and rows(again.read()) == want


def test_a_step_writes_its_changes_only(spark, tmp):
    log = SnapshotLog(spark, f"{tmp}/snap", buckets=32)
    base = spark.range(3000).selectExpr("id AS user_id", "500 AS score", "timestamp_ntz'2024-01-01' AS updated_at")
    log.step(base, ntz("2024-01-01 00:00:00"))
    sizes = []
    for i in range(1, 6):
        before = data_files(f"{tmp}/snap")
        changed = base.withColumn("hit", F.col("user_id") == i).selectExpr(
            "user_id", f"IF(hit, {600 + i}, score) AS score", f"IF(hit, timestamp_ntz'2024-02-0{i}', updated_at) AS updated_at")
        # Users 1..i-1 keep their earlier change: an older row is ignored.
        log.step(changed, ntz(f"2024-03-0{i} 00:00:00"))
        after = data_files(f"{tmp}/snap")
        assert all(after[f] == t for f, t in before.items())  # nothing is rewritten in place
        new = [f for f in after if f not in before]
        sizes.append(spark.read.parquet(*new).count() if len(new) == 1 else sum(spark.read.parquet(f).count() for f in new))
        touched = [f for f in new if "/open/" in f]
        assert len(touched) == 1  # one bucket of 32
        assert sum(spark.read.parquet(f).count() for f in new if "/changes/" in f) == 2
    assert max(sizes) < 3000 / 32 * 2 and max(sizes) - min(sizes) < 60  # no growth with the history
    assert log.read().count() == 3005


def test_lookup_opens_a_bounded_number_of_files(spark, tmp):
    log = SnapshotLog(spark, f"{tmp}/snap", buckets=16)
    for i in range(6):
        batch = spark.range(400).selectExpr("id AS user_id", f"{500 + i} AS score",
                                            f"timestamp_ntz'2024-01-01' + make_dt_interval({i}) AS updated_at")
        log.step(batch, ntz(f"2024-02-0{i + 1} 00:00:00"))
    assert files_read(log.of_users([57], history=False)) == 1
    log.compact()
    assert files_read(log.of_users([57])) == 2  # of more than 30: its bucket, open and closed
    assert log.of_users([57]).count() == 6
    assert files_read(log.read()) >= 32


def test_a_failed_step_is_done_again(spark, tmp, monkeypatch):
    log = SnapshotLog(spark, f"{tmp}/snap", buckets=4)
    b1 = spark.createDataFrame([(i, 500, D(2024, 1, 1)) for i in range(10)], S)
    b2 = spark.createDataFrame([(i, 500 + (i == 3), D(2024, 1, 1 + (i == 3))) for i in range(9)], S)
    log.step(b1, ntz("2024-01-01 00:00:00"))
    before = rows(log.read())

    def fail(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(log, "_write_open", fail)  # after the changes are written
        with pytest.raises(RuntimeError):
            log.step(b2, ntz("2024-01-05 00:00:00"))
    assert rows(log.read()) == before and log.version() == 1
    log.step(b2, ntz("2024-01-05 00:00:00"))
    assert rows(log.read()) == rows(scd2.snapshot_batches([b1, b2], [ntz("2024-01-05 00:00:00")]))
    log.step(b2, ntz("2024-01-06 00:00:00"))  # nothing new
    assert log.version() == 3 and log.changed_keys(2).count() == 0 and log.changed_keys(1).count() == 2
