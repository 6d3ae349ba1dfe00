"""Fraud alert rules (R1-R6) and the risk-band consistency check.

Each rule is NULL-safe: an unknown input never raises an alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewatch.functions import constants as K

FLAGS = ("alert_high_amount", "alert_limit_exceeded", "alert_velocity",
         "alert_location_shift", "alert_source_flag")


def _safe(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def high_amount(amount: Column, threshold=K.HIGH_AMOUNT_USD) -> Column:
    return _safe(amount >= F.lit(threshold))


def limit_exceeded(amount: Column, limit: Column) -> Column:
    return _safe(amount > limit)


def velocity(cnt_5min: Column, threshold=K.VELOCITY_MIN_TX_5MIN) -> Column:
    return _safe(cnt_5min >= F.lit(threshold))


def location_shift(tx_location: Column, user_location: Column) -> Column:
    return _safe(tx_location != user_location)


def source_flag(flag: Column) -> Column:
    return _safe(flag)


def evaluate(df: DataFrame) -> DataFrame:
    """Add the five flags and ``is_fraud_alert`` to rows carrying
    ``amount_usd, limite_credito, cnt_5min, location, user_location,
    is_flagged_fraud``."""
    out = df.select(
        "*",
        high_amount(F.col("amount_usd")).alias("alert_high_amount"),
        limit_exceeded(F.col("amount_usd"), F.col("limite_credito")).alias("alert_limit_exceeded"),
        velocity(F.col("cnt_5min")).alias("alert_velocity"),
        location_shift(F.col("location"), F.col("user_location")).alias("alert_location_shift"),
        source_flag(F.col("is_flagged_fraud")).alias("alert_source_flag"),
    )
    any_flag = F.col(FLAGS[0])
    for f in FLAGS[1:]:
        any_flag = any_flag | F.col(f)
    return out.withColumn("is_fraud_alert", any_flag)


def risk_band(score: Column) -> Column:
    return (F.when(score >= K.RISK_BAND_BAJO_MIN, F.lit(K.RISK_BAJO))
            .when(score >= K.RISK_BAND_MEDIO_MIN, F.lit(K.RISK_MEDIO))
            .when(score.isNotNull(), F.lit(K.RISK_ALTO)))


def risk_band_check(users: DataFrame) -> DataFrame:
    """Versions whose stored status is not the band of their score."""
    expected = risk_band(F.col("scoring_crediticio"))
    return (users.select("user_id", "valid_from", "scoring_crediticio", "status_riesgo", expected.alias("expected_status"))
            .filter(~F.col("status_riesgo").eqNullSafe(F.col("expected_status"))))
