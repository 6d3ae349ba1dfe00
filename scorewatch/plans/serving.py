"""Served queries: score lookups, alert lists, hourly/daily fraud rates,
score histogram and alerts per rule (Q1-Q9, P7-P9, G1-G5).

Every function takes marts and parameters and returns a DataFrame. Time
windows are relative to an explicit ``as_of`` instant instead of ``now()``
so results are reproducible. Top-N lists sort by time descending with
``transaction_id`` as tie-break and plan as ``TakeOrderedAndProject`` (each
task keeps its own top N; no global sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scorewatch.functions import constants as K
from scorewatch.functions.timecols import trunc_ntz
from scorewatch.operators.rules import FLAGS

HISTORY_COLS = ("user_id", "nombre", "scoring_crediticio", "status_riesgo", "limite_credito",
                "location", "valid_from", "dbt_valid_to", "is_current")
ALERT_LIST_COLS = ("transaction_id", "user_id", "created_at", "amount_usd", "merchant_category",
                   *FLAGS, "is_fraud_alert")
FEED_COLS = ("created_at", "user_id", "amount_usd", "merchant_category", *FLAGS)


def _since(df: DataFrame, since: Column) -> DataFrame:
    """``created_at >= since``, plus the same bound on the ``event_date``
    partition column when the table has one, so the scan prunes days."""
    out = df.filter(F.col("created_at") >= since)
    if "event_date" in df.columns:
        out = out.filter(F.col("event_date") >= F.to_date(since))
    return out


def _for_users(df: DataFrame, users) -> DataFrame:
    if users is None:
        return df
    if isinstance(users, DataFrame):
        return df.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return df.filter(F.col("user_id").isin(list(users)))


def credit_score_history(dim: DataFrame, users: Sequence[int] | DataFrame | None = None) -> DataFrame:
    """Score history, oldest version first (Q1). ``users``: ids, a frame
    with ``user_id``, or None for everyone. Unknown users give no rows."""
    return _for_users(dim, users).select(*HISTORY_COLS).orderBy("user_id", "valid_from")


def credit_score_current(dim: DataFrame, users=None) -> DataFrame:
    """The open version of each requested user (Q2)."""
    return _for_users(dim.filter(F.col("is_current")), users).select(*HISTORY_COLS)


def active_alerts(alerts: DataFrame, limit: int = K.ALERTS_LIMIT_DEFAULT,
                  user_id: int | None = None) -> DataFrame:
    """Newest alerts first, optionally for one user."""
    if not 1 <= limit <= K.ALERTS_LIMIT_MAX:
        raise ValueError(f"limit must be within 1..{K.ALERTS_LIMIT_MAX}")
    df = alerts.filter(F.col("is_fraud_alert"))
    if user_id is not None:
        df = df.filter(F.col("user_id") == F.lit(user_id))
    return (df.orderBy(F.col("created_at").desc_nulls_first(), F.col("transaction_id").desc())
            .select(*ALERT_LIST_COLS).limit(limit))


def _rate(alerts: DataFrame, bucket: Column, name: str) -> DataFrame:
    total = F.count(F.lit(1))
    flagged = F.count_if(F.col("is_fraud_alert"))
    pct = F.round(F.lit(100.0).cast("decimal(4,1)") * flagged / F.nullif(total, F.lit(0)), 2)
    return (alerts.groupBy(bucket.alias(name))
            .agg(total.alias("tx_total"), flagged.alias("tx_con_alertas"),
                 pct.cast("double").alias("pct_fraude")))


def fraud_summary(alerts: DataFrame, as_of: Column, hours: int = K.SUMMARY_HOURS_DEFAULT) -> DataFrame:
    """Transactions, alerts and fraud % per hour over the last ``hours``
    before ``as_of`` (Q4, P9, G2, G3)."""
    if not 1 <= hours <= K.SUMMARY_HOURS_MAX:
        raise ValueError(f"hours must be within 1..{K.SUMMARY_HOURS_MAX}")
    since = as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(hours))
    recent = _since(alerts, since)
    return _rate(recent, trunc_ntz("hour", F.col("created_at")), "hora").orderBy(F.col("hora").desc())


def fraud_pct_by_hour(alerts: DataFrame, limit: int = K.HOURLY_PANEL_LIMIT) -> DataFrame:
    """Dashboard panel: fraud % for the latest ``limit`` hours (Q5)."""
    return (_rate(alerts, trunc_ntz("hour", F.col("created_at")), "hora")
            .orderBy(F.col("hora").desc_nulls_first()).limit(limit))


def fraud_pct_by_day(alerts: DataFrame) -> DataFrame:
    """Dashboard panel by day (Q6)."""
    return _rate(alerts, trunc_ntz("day", F.col("created_at")), "dia").orderBy(F.col("dia").desc_nulls_first())


def score_distribution(dim: DataFrame) -> DataFrame:
    """Current users by risk status and score bucket (Q7, G1)."""
    bucket = F.width_bucket(F.col("scoring_crediticio"), F.lit(K.SCORE_MIN), F.lit(K.SCORE_MAX),
                            F.lit(K.SCORE_BUCKETS))
    return (dim.filter(F.col("is_current"))
            .groupBy("status_riesgo", bucket.alias("bucket"))
            .agg(F.min("scoring_crediticio").alias("min_score"),
                 F.max("scoring_crediticio").alias("max_score"),
                 F.count(F.lit(1)).alias("usuarios"))
            .orderBy(F.col("status_riesgo").asc_nulls_last(), F.col("bucket").asc_nulls_last()))


def alert_feed(alerts: DataFrame, limit: int = K.FEED_LIMIT, as_of: Column | None = None,
               minutes: int | None = None) -> DataFrame:
    """Latest alerts with the rule breakdown (Q8); with ``as_of`` and
    ``minutes`` only those of the last minutes (the radar)."""
    df = alerts.filter(F.col("is_fraud_alert"))
    if as_of is not None and minutes is not None:
        since = as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
        df = _since(df, since)
    return (df.orderBy(F.col("created_at").desc_nulls_first(), F.col("transaction_id").desc())
            .limit(limit).select(*FEED_COLS))


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    """Alerts counted per rule, one pass, all five rules always present (Q9)."""
    counts = alerts.filter(F.col("is_fraud_alert")).agg(
        *[F.count_if(F.col(f)).alias(f) for f in FLAGS])
    pairs = ", ".join(f"'{label}', `{flag}`" for label, flag in zip(K.RULE_LABELS, FLAGS))
    return (counts.selectExpr(f"stack({len(FLAGS)}, {pairs}) as (regla, alertas)")
            .orderBy(F.col("alertas").desc(), F.col("regla")))
