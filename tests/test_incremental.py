"""Change-driven build, rollup panels and newest-first reads."""

import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorewatch.functions.timecols import ntz
from scorewatch.operators import scd2
from scorewatch.operators.velocity import user_transaction_velocity
from scorewatch.plans import marts, newest, rollup, serving, staging
from scorewatch.plans.incremental import IncrementalBuild
from scorewatch.plans.pipeline import with_event_date
from scorewatch.sources.partitioned import PartitionedTable

TX = ("id long, user_id long, amount decimal(15,2), merchant_category string, location string, is_flagged_fraud boolean, "
      "created_at timestamp_ntz")
US = "id long, nombre string, scoring_crediticio int, limite_credito decimal(15,2), status_riesgo string, location string, updated_at timestamp_ntz"
D0 = dt.datetime(2024, 3, 1)


def tx(i, user, day, minute, amount=10, flag=False):
    at = None if day is None else D0 + dt.timedelta(days=day, minutes=minute)
    return (i, user, Decimal(amount), "shop", "AR", flag, at)


def user(u, limit, day=0):
    return (u, f"n{u}", 700, Decimal(limit), "bajo", "AR", D0 + dt.timedelta(days=day))


def same(got, want):
    cols = want.columns
    return sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.collect()))


def files(build, table):
    out = {}
    for f in glob.glob(f"{build.tables[table].root}/w=*/**/*.parquet", recursive=True):
        out.setdefault(f.split("event_date=")[1].split("/")[0], set()).add((f, os.stat(f).st_mtime_ns))
    return out


def check(spark, build, delivered, batches, runs):
    """Every table equals one built from all that was ever delivered."""
    staged = staging.stg_transactions(spark.createDataFrame(delivered, TX))
    dim = marts.dim_users(scd2.snapshot_batches([staging.stg_users(spark.createDataFrame(b, US)) for b in batches], runs[1:]))
    assert same(marts.dim_users(build.snapshot.read()), dim)
    alerts = marts.fct_fraud_alerts(staged, dim)
    for name, want in (("stg_transactions", staged), ("int_user_transaction_velocity", user_transaction_velocity(staged)),
                       ("fct_transactions", marts.fct_transactions(staged, dim)), ("fct_fraud_alerts", alerts),
                       ("alerts_hourly", rollup.hourly(alerts))):
        got = build.tables[name].read()
        assert same(got, want), name
        if "created_at" in got.columns:
            assert got.filter(~F.col("event_date").eqNullSafe(F.to_date("created_at"))).count() == 0


def test_runs_equal_a_full_build(spark, tmp):
    build = IncrementalBuild(spark, f"{tmp}/out", buckets=4)
    users1 = [user(u, 1000) for u in range(6)]
    first = [tx(d * 100 + i, i % 3, d, 1400 + 2 * i) for d in range(4) for i in range(9)] + [tx(900, 4, 1, 0), tx(901, 1, None, 0)]
    runs = [ntz("2024-04-01 00:00:00"), ntz("2024-04-02 00:00:00"), ntz("2024-04-03 00:00:00"), ntz("2024-04-04 00:00:00")]
    build.apply(spark.createDataFrame(first, TX), spark.createDataFrame(users1, US), runs[0])
    delivered, batches = list(first), [users1]
    check(spark, build, delivered, batches, runs[:1])

    # A late row of day 0, close to midnight: it reaches into day 1 and no further.
    before = {t: files(build, t) for t in build.tables}
    late = [tx(50, 2, 0, 1439), tx(0, 0, 0, 1400)]  # and a re-delivery that changes nothing
    dates = build.apply(spark.createDataFrame(late, TX), spark.createDataFrame(users1, US), runs[1])
    delivered += late
    batches.append(users1)
    assert dates == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    check(spark, build, delivered, batches, runs[:2])
    for t in build.tables:
        after = files(build, t)
        changed = {d for d in after if after[d] != before[t].get(d)}
        assert changed == ({"2024-03-01"} if t == "stg_transactions" else {"2024-03-01", "2024-03-02"}), t

    # A lower limit of user 4, who has transactions on one day only, alters that day's alerts.
    before = {t: files(build, t) for t in build.tables}
    users3 = [user(4, 5, day=10) if u[0] == 4 else u for u in users1 if u[0] != 5]
    dates = build.apply(spark.createDataFrame([], TX), spark.createDataFrame(users3, US), runs[2])
    batches.append(users3)
    assert dates == [dt.date(2024, 3, 2)]
    check(spark, build, delivered, batches, runs[:3])
    assert {d for d, f in files(build, "fct_fraud_alerts").items() if f != before["fct_fraud_alerts"].get(d)} == {"2024-03-02"}
    assert files(build, "stg_transactions") == before["stg_transactions"]

    # An earlier delivery moves a transaction to another day; its old day is left empty.
    moved = [tx(900, 4, 0, 3)]
    only = [tx(777, 1, 9, 5)]
    build.apply(spark.createDataFrame(only, TX), spark.createDataFrame(users3, US), runs[3])
    batches.append(users3)
    back = [tx(777, 1, 2, 5)]
    runs.append(ntz("2024-04-05 00:00:00"))
    batches.append(users3)
    dates = build.apply(spark.createDataFrame(moved + back, TX), spark.createDataFrame(users3, US), runs[4])
    delivered += moved + only + back
    assert dt.date(2024, 3, 10) not in dates and dt.date(2024, 3, 3) in dates
    assert "2024-03-10" not in build.tables["fct_transactions"].folders()
    check(spark, build, delivered, batches, runs)


@pytest.mark.parametrize("stop", ["_replace_staged", "_write_facts"])
def test_a_run_that_failed_is_taken_up(spark, tmp, monkeypatch, stop):
    build = IncrementalBuild(spark, f"{tmp}/out", buckets=2)
    users1, users2 = [user(1, 1000), user(2, 1000)], [user(1, 5, day=9), user(2, 1000)]
    first, more = [tx(d, 1 + d % 2, d, 30) for d in range(4)], [tx(20, 2, 1, 60)]
    runs = [ntz(f"2024-04-0{i} 00:00:00") for i in (1, 2, 3)]
    build.apply(spark.createDataFrame(first, TX), spark.createDataFrame(users1, US), runs[0])

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(build, stop, fail)
        with pytest.raises(RuntimeError):
            build.apply(spark.createDataFrame(more, TX), spark.createDataFrame(users2, US), runs[1])
    build.apply(spark.createDataFrame(more, TX), spark.createDataFrame(users2, US), runs[2])
    check(spark, build, first + more, [users1, users2, users2], runs)
    assert build._open_dates() == set()  # nothing is left over


def some_alerts(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(4), None if i % 90 == 0 else D0 + dt.timedelta(days=rng.randrange(12), minutes=rng.randrange(1440)), Decimal(i), "c",
             rng.random() < .5, False, rng.random() < .2, False, i % 7 == 0, i % 40 == 0 or i % 90 == 0) for i in range(800)]
    schema = "transaction_id long, user_id long, created_at timestamp_ntz, amount_usd decimal(15,2), merchant_category string, " + ", ".join(
        f"{f} boolean" for f in (*marts.rules.FLAGS, "is_fraud_alert"))
    return with_event_date(spark.createDataFrame(rows, schema))


def test_panels_from_the_rollup(spark):
    alerts = some_alerts(spark)
    hours = rollup.hourly(alerts)
    assert same(rollup.fraud_pct_by_day(hours), serving.fraud_pct_by_day(alerts))
    assert same(rollup.fraud_pct_by_hour(hours, 30), serving.fraud_pct_by_hour(alerts, 30))
    assert same(rollup.alerts_by_rule(hours), serving.alerts_by_rule(alerts))
    assert same(rollup.alerts_by_rule(hours.limit(0)), serving.alerts_by_rule(alerts.limit(0)))
    for at in ("2024-03-10 12:00:00", "2024-03-10 12:34:56", "2024-03-05 00:00:01"):
        assert same(rollup.fraud_summary(hours, ntz(at), 24, alerts), serving.fraud_summary(alerts, ntz(at), 24))
    assert same(rollup.fraud_summary(hours, ntz("2024-03-10 12:00:00")), serving.fraud_summary(alerts, ntz("2024-03-10 12:00:00")))
    with pytest.raises(Exception, match="full hour"):
        rollup.fraud_summary(hours, ntz("2024-03-10 12:34:56")).collect()


def test_newest_first_reads_the_newest_dates_only(spark, tmp):
    alerts = some_alerts(spark)
    table = PartitionedTable(spark, f"{tmp}/alerts", "event_date")
    table.replace(alerts, layout=lambda df: df.repartitionByRange("event_date"))
    for limit, who in ((1, None), (5, None), (12, None), (500, None), (3, 2), (50, 1), (2, 99)):
        got = newest.active_alerts(table, limit, who).collect()
        assert got == serving.active_alerts(alerts, limit, who).collect(), (limit, who)
    assert newest.alert_feed(table, 15).collect() == serving.alert_feed(alerts, 15).collect()

    def dates_read(df):
        return {p.split("event_date=")[1].split("/")[0] for p in df.inputFiles()}

    per_day = {str(r[0]): r[1] for r in alerts.filter("is_fraud_alert").groupBy("event_date").count().collect()}
    nine = per_day["None"] + 2  # the rows without a time come first
    assert len(dates_read(newest.active_alerts(table, nine))) <= 4
    assert len(dates_read(newest.active_alerts(table, per_day["None"]))) == 1
    assert len(dates_read(newest.active_alerts(table, 2, user_id=99))) == len(table.folders())
