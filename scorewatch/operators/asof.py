"""As-of join: each fact row meets the dimension version valid at its time.

Versions of one key do not overlap; a fact at time ``ts`` takes the version
with ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``, if any.

Two plans:

* ``strategy="merge"`` (default): equi-join on the key with the validity
  range as a residual condition (sort-merge or broadcast hash join; never a
  nested loop). Each fact is checked against the versions of its key, so
  the work is facts x versions-per-key: small for a score history (tens to
  hundreds of versions per user), and a hot key on the fact side is split
  by AQE's skew-join handling.
* ``strategy="carry"``: no pairs at all, for dimensions with very many
  versions per key. Versions (at their
  ``valid_from``) and facts (at their time) are put in one frame and bucketed
  by ``(key, floor(time / bucket))``. A narrow per-bucket table holds each
  bucket's last version; over a key's buckets in order it yields the last
  version of all earlier buckets (the carry). Joined back on the bucket key,
  one ordered pass per bucket forward-fills the latest version seen so far
  (versions sort before facts at equal times); if none, the carry applies.
  One big exchange, linear work, and a hot key is split by time buckets;
  it costs a few small extra stages (a per-bucket aggregate and its carry).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from scorewatch.functions.timecols import epoch_micros


def asof_join(facts: DataFrame, versions: DataFrame, key: str, ts_col: str,
              valid_from: str = "valid_from", valid_to: str = "dbt_valid_to",
              select: Sequence[str] = (), how: str = "left", strategy: str = "merge",
              bucket_seconds: int = 86_400) -> DataFrame:
    if strategy == "merge":
        return _asof_merge(facts, versions, key, ts_col, valid_from, valid_to, select, how)
    if strategy != "carry":
        raise ValueError(f"unknown strategy {strategy!r}")
    out = _asof_carry(facts, versions, key, ts_col, valid_from, valid_to, select, bucket_seconds)
    if how == "inner":
        return out.filter(F.col("_matched")).drop("_matched")
    if how != "left":
        raise ValueError("how must be 'left' or 'inner'")
    return out.drop("_matched")


def _asof_merge(facts, versions, key, ts_col, valid_from, valid_to, select, how):
    v = versions.select(F.col(key).alias("_v_key"), F.col(valid_from).alias("_v_from"),
                        F.col(valid_to).alias("_v_to"), *select)
    ts = F.col(ts_col)
    cond = ((F.col(key) == F.col("_v_key")) & (F.col("_v_from") <= ts)
            & (F.col("_v_to").isNull() | (ts < F.col("_v_to"))))
    return facts.join(v, cond, how).drop("_v_key", "_v_from", "_v_to")


def _asof_carry(facts, versions, key, ts_col, valid_from, valid_to, select, bucket_seconds):
    bucket_us = bucket_seconds * 1_000_000
    if bucket_us < 1:
        raise ValueError("bucket_seconds must be positive")
    ver_fields = [valid_from, valid_to, *select]
    ver = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_k"), epoch_micros(F.col(valid_from)).alias("_t"), F.lit(0).alias("_kind"),
        F.struct(*[F.col(c) for c in ver_fields]).alias("_ver"),
        *[F.lit(None).cast(t).alias(c) for c, t in facts.dtypes])
    ver_type = ver.schema["_ver"].dataType
    fct = facts.select(
        F.col(key).alias("_k"), epoch_micros(F.col(ts_col)).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(ver_type).alias("_ver"), *facts.columns)
    events = ver.unionByName(fct).withColumn("_b", F.floor(F.col("_t") / F.lit(bucket_us)))

    per_bucket = events.groupBy("_k", "_b").agg(F.max_by("_ver", F.when(F.col("_kind") == 0, F.col("_t")))
                                              .alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"),
                              F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    joined = events.join(carry, (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left")

    so_far = (Window.partitionBy("_k", "_b").orderBy("_t", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cand = F.coalesce(F.last("_ver", ignorenulls=True).over(so_far), F.col("_carry"))
    filled = joined.select("*", cand.alias("_cand")).filter(F.col("_kind") == 1)
    ts = F.col(ts_col)
    ok = (F.col("_k").isNotNull() & ts.isNotNull() & F.col("_cand").isNotNull()
          & (F.col(f"_cand.{valid_to}").isNull() | (ts < F.col(f"_cand.{valid_to}"))))
    return filled.select(*facts.columns, *[F.when(ok, F.col(f"_cand.{c}")).alias(c) for c in select],
                         F.coalesce(ok, F.lit(False)).alias("_matched"))
