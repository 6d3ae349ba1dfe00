"""Hot keys: one user, one copy group holding a large share of all rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from scorewatch.operators.dedup import keep_earliest
from scorewatch.operators.velocity import spread_over_buckets, with_velocity

T0 = dt.datetime(2024, 1, 1)


def test_hot_user_spreads_over_buckets(spark):
    n = 30_000
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2).cast("long").alias("user_id"),
        F.timestamp_add("SECOND", F.col("id") * 7 % 86400, F.lit(T0).cast("timestamp_ntz")).alias("created_at"),
        F.lit(Decimal("1.00")).cast("decimal(15,2)").alias("amount_usd"))
    out = with_velocity(df, windows_min=(60,), metrics=("cnt",))
    assert out.count() == n
    # The operator's own window groups: with buckets of the window's width, no
    # group holds more than two of the hot user's 24 hours.
    def largest(frame, minutes):
        groups = spread_over_buckets(frame, "user_id", "created_at", "amount_usd", 60, minutes).groupBy("user_id", "_pb").count()
        return groups.agg(F.max("count")).first()[0]
    hour = F.floor(F.timestamp_diff("MINUTE", F.lit(T0).cast("timestamp_ntz"), F.col("created_at")) / 60)
    busiest = df.groupBy("user_id", hour.alias("h")).count().agg(F.max("count")).first()[0]
    assert largest(df, 60) <= 2 * busiest < n // 3 / 8 and largest(df, None) <= 5 * busiest < n // 3 / 3
    # Rows without a user are spread too; every one of them has a count of 0.
    nobody = df.withColumn("user_id", F.when(F.col("transaction_id") % 2 == 0, F.col("user_id")))
    assert largest(nobody.filter("user_id IS NULL"), None) < 60
    assert with_velocity(nobody, windows_min=(60,), metrics=("cnt",)).filter("user_id IS NULL AND cnt_60min = 0").count() == n // 2
    # Same result as a plain per-user window over the whole history.
    from pyspark.sql import Window
    from scorewatch.functions.timecols import epoch_micros
    w = Window.partitionBy("user_id").orderBy(epoch_micros(F.col("created_at"))).rangeBetween(-(3600 * 10**6 - 1), 0)
    plain = df.select("transaction_id", F.count(F.lit(1)).over(w).alias("cnt_60min"))
    assert out.select("transaction_id", "cnt_60min").exceptAll(plain).count() == 0


def test_hot_copy_group_is_cut_before_shuffle(spark):
    copies = spark.range(50_000).select(
        F.lit(7).cast("long").alias("id"),
        F.timestamp_add("SECOND", F.col("id"), F.lit(T0).cast("timestamp_ntz")).alias("created_at"),
        F.col("id").alias("payload"))
    others = spark.range(1000).select((F.col("id") + 100).alias("id"), F.lit(T0).cast("timestamp_ntz").alias("created_at"),
                                      F.col("id").alias("payload"))
    out = keep_earliest(copies.unionByName(others), "id", "created_at")
    rows = out.filter("id = 7").collect()
    assert [r.payload for r in rows] == [0] and out.count() == 1001
