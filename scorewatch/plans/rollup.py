"""Hourly rollup of the alert mart and the panels served from it (Q4-Q6, Q9).

One row per hour: transactions, alerts, and alerts per rule. The counts add up,
so hours make days and totals, and a date's hours can be computed again without
the others. Panels read this table instead of the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewatch.functions import constants as K
from scorewatch.functions.timecols import trunc_ntz
from scorewatch.operators.rules import FLAGS

COUNTS = ("tx_total", "tx_con_alertas", *(f"n_{f}" for f in FLAGS))


def hourly(alerts: DataFrame) -> DataFrame:
    """``hora``, ``event_date`` and the counts, one row per hour with
    transactions (and one for those without a time)."""
    alert = F.col("is_fraud_alert")
    hour = trunc_ntz("hour", F.col("created_at"))
    return (alerts.groupBy(hour.alias("hora")).agg(
        F.count(F.lit(1)).alias("tx_total"), F.count_if(alert).alias("tx_con_alertas"),
        *[F.count_if(alert & F.col(f)).alias(f"n_{f}") for f in FLAGS])
        .withColumn("event_date", F.to_date("hora")))


def _added_up(rollup: DataFrame, bucket: Column, name: str) -> DataFrame:
    total, flagged = F.sum("tx_total"), F.sum("tx_con_alertas")
    pct = F.round(F.lit(100.0).cast("decimal(4,1)") * flagged / F.nullif(total, F.lit(0)), 2)
    return rollup.groupBy(bucket.alias(name)).agg(
        total.alias("tx_total"), flagged.alias("tx_con_alertas"), pct.cast("double").alias("pct_fraude"))


def fraud_summary(rollup: DataFrame, as_of: Column, hours: int = K.SUMMARY_HOURS_DEFAULT,
                  alerts: DataFrame | None = None) -> DataFrame:
    """Per hour over the last ``hours`` before ``as_of`` (Q4). The first hour
    is a part of one unless ``as_of`` is a full hour; its transactions come from
    ``alerts`` then (an error if that isn't given)."""
    if not 1 <= hours <= K.SUMMARY_HOURS_MAX:
        raise ValueError(f"hours must be within 1..{K.SUMMARY_HOURS_MAX}")
    since = as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))
    first = trunc_ntz("hour", since)
    whole = F.when(first == since, since).otherwise(first + F.make_dt_interval(F.lit(0), F.lit(1)))
    recent = rollup.filter((F.col("hora") >= whole) & (F.col("event_date") >= F.to_date(since)))
    if alerts is None:
        recent = recent.filter(F.assert_true(first == since, "as_of is not a full hour: give the alerts too").isNull())
    else:
        edge = alerts.filter((F.col("created_at") >= since) & (F.col("created_at") < whole))
        if "event_date" in alerts.columns:
            edge = edge.filter(F.col("event_date").between(F.to_date(since), F.to_date(whole)))
        recent = recent.unionByName(hourly(edge).select(*recent.columns))
    return _added_up(recent, F.col("hora"), "hora").orderBy(F.col("hora").desc())


def fraud_pct_by_hour(rollup: DataFrame, limit: int = K.HOURLY_PANEL_LIMIT) -> DataFrame:
    """Fraud % of the latest ``limit`` hours (Q5)."""
    return _added_up(rollup, F.col("hora"), "hora").orderBy(F.col("hora").desc_nulls_first()).limit(limit)


def fraud_pct_by_day(rollup: DataFrame) -> DataFrame:
    """Fraud % by day (Q6)."""
    return _added_up(rollup, trunc_ntz("day", F.col("hora")), "dia").orderBy(F.col("dia").desc_nulls_first())


def alerts_by_rule(rollup: DataFrame) -> DataFrame:
    """Alerts per rule, all five always present (Q9)."""
    counts = rollup.agg(*[F.coalesce(F.sum(f"n_{f}"), F.lit(0)).alias(f) for f in FLAGS])
    pairs = ", ".join(f"'{label}', `{flag}`" for label, flag in zip(K.RULE_LABELS, FLAGS))
    return (counts.selectExpr(f"stack({len(FLAGS)}, {pairs}) as (regla, alertas)")
            .orderBy(F.col("alertas").desc(), F.col("regla")))
