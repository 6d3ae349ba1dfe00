"""Timing of the velocity operator under skew: one user holds a third of
6M generated rows (used only for this timing, never by a registered query).
Compares a plain per-user range window with the bucketed operator and checks
that both give the same counts.

    python tools/skew_velocity.py
"""
import os
import sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F, Window
from scorewatch.session import local_session
from scorewatch.operators.velocity import with_velocity
from scorewatch.functions.timecols import epoch_micros, MICROS_PER_MINUTE
spark = local_session(8, 32)
n = 6_000_000
T0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
df = spark.range(n).select(
    F.col("id").alias("transaction_id"),
    F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 100000 + 2).cast("long").alias("user_id"),
    F.timestamp_add("MICROSECOND", (F.col("id") * 7919 % (30 * 86400)) * 1000000 + F.col("id") % 1000, T0).alias("created_at"),
    (F.col("id") % 1000 / 10).cast("decimal(15,2)").alias("amount_usd"))
def plain():
    us = epoch_micros(F.col("created_at"))
    cols = []
    for w in (5, 15, 60):
        fr = Window.partitionBy("user_id").orderBy(us).rangeBetween(-(w * MICROS_PER_MINUTE - 1), 0)
        cols += [F.count(F.lit(1)).over(fr).alias(f"cnt_{w}min"), F.sum("amount_usd").over(fr).alias(f"sum_{w}min")]
    return df.select("transaction_id", *cols)
def plain_prefix():
    us = epoch_micros(F.col("created_at"))
    spec = Window.partitionBy("user_id").orderBy(us)
    now = spec.rangeBetween(Window.unboundedPreceding, 0)
    cols = []
    for w in (5, 15, 60):
        before = spec.rangeBetween(Window.unboundedPreceding, -w * MICROS_PER_MINUTE)
        cols += [(F.count(F.lit(1)).over(now) - F.count(F.lit(1)).over(before)).alias(f"cnt_{w}min"),
                 (F.coalesce(F.sum("amount_usd").over(now), F.lit(0))
                  - F.coalesce(F.sum("amount_usd").over(before), F.lit(0))).alias(f"sum_{w}min")]
    return df.select("transaction_id", *cols)
def bucketed():
    return with_velocity(df).select("transaction_id", "cnt_5min", "sum_5min", "cnt_15min", "sum_15min", "cnt_60min", "sum_60min")
def probe():
    return with_velocity(df, strategy="probe", bucket_seconds=60).select(
        "transaction_id", "cnt_5min", "sum_5min", "cnt_15min", "sum_15min", "cnt_60min", "sum_60min")
for name, f in (("plain", plain), ("plain_prefix", plain_prefix), ("bucketed", bucketed), ("probe_60s", probe),
                ("plain", plain), ("plain_prefix", plain_prefix), ("bucketed", bucketed), ("probe_60s", probe)):
    s = time.perf_counter(); f().write.format("noop").mode("overwrite").save(); print(name, round(time.perf_counter() - s, 1))
a = plain().select("transaction_id", "cnt_60min"); b = bucketed().select("transaction_id", "cnt_60min")
c = probe().select("transaction_id", "cnt_60min")
print("equal:", a.exceptAll(b).count() == 0, b.exceptAll(c).count() == 0)
