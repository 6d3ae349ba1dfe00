"""Marts: ``dim_users`` (P6), ``fct_transactions`` (J1), the as-of variant
(J4) and ``fct_fraud_alerts`` (J2, J3, R1).

The alert mart needs, per transaction, the 5-minute velocity and the current
user's limit and location. Velocity is computed on the staged rows
themselves (the velocity table is 1:1 with them on ``transaction_id``), which
saves the join back on ``transaction_id``. The current-user join shuffles on
``user_id`` unless AQE measures the user side small enough to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scorewatch.operators import rules
from scorewatch.operators.asof import asof_join
from scorewatch.operators.velocity import with_velocity

TX_COLS = ("transaction_id", "user_id", "created_at", "amount_usd", "merchant_category",
           "location", "is_flagged_fraud")
ALERT_COLS = ("transaction_id", "user_id", "created_at", "amount_usd", "merchant_category",
              *rules.FLAGS, "is_fraud_alert")


def dim_users(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "user_id", F.col("dbt_scd_id").alias("user_sk"), "nombre", "scoring_crediticio",
        "limite_credito", "status_riesgo", "location",
        F.col("dbt_valid_from").alias("valid_from"), "dbt_valid_to",
        F.col("dbt_valid_to").isNull().alias("is_current"))


def current_users(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def fct_transactions(stg_tx: DataFrame, dim: DataFrame) -> DataFrame:
    """Transactions with the user's current version (as the model's code does)."""
    cur = current_users(dim).select(
        F.col("user_id").alias("_uid"), "user_sk", "scoring_crediticio", "status_riesgo")
    return (stg_tx.select(*TX_COLS)
            .join(cur, F.col("user_id") == F.col("_uid"), "left").drop("_uid"))


def fct_transactions_asof(stg_tx: DataFrame, dim: DataFrame, **plan) -> DataFrame:
    """Transactions with the version valid at transaction time (the model's
    stated intent). ``plan`` (``strategy``, ``bucket_seconds``) passes through
    to :func:`asof_join`."""
    return asof_join(stg_tx.select(*TX_COLS), dim, "user_id", "created_at",
                     select=("user_sk", "scoring_crediticio", "status_riesgo"), **plan)


def fct_fraud_alerts(stg_tx: DataFrame, dim: DataFrame, bucket_minutes: int | str | None = None,
                     **velocity_kw) -> DataFrame:
    """``velocity_kw`` (``strategy``, ``bucket_seconds``) pass through to
    :func:`with_velocity`."""
    vel = with_velocity(stg_tx.select(*TX_COLS), windows_min=(5,), metrics=("cnt",),
                        bucket_minutes=bucket_minutes, **velocity_kw)
    # The velocity model is joined on transaction_id: a NULL id finds no row.
    vel = vel.withColumn("cnt_5min", F.when(F.col("transaction_id").isNotNull(), F.col("cnt_5min")))
    return _alerts(vel, dim)


def fct_fraud_alerts_from(stg_tx: DataFrame, velocity: DataFrame, dim: DataFrame) -> DataFrame:
    """The same from the published velocity model, joined on its key."""
    cnt = velocity.select(F.col("transaction_id").alias("_tid"), "cnt_5min")
    vel = stg_tx.select(*TX_COLS).join(cnt, F.col("transaction_id") == F.col("_tid"), "left").drop("_tid")
    return _alerts(vel, dim)


def _alerts(vel: DataFrame, dim: DataFrame) -> DataFrame:
    return facts_and_alerts(vel, dim).select(*ALERT_COLS)


#: Columns of the user that ``fct_transactions`` has and the alerts don't need.
FACT_USER_COLS = ("user_sk", "scoring_crediticio", "status_riesgo")


def facts_and_alerts(vel: DataFrame, dim: DataFrame, user_cols: Sequence[str] = ()) -> DataFrame:
    """Each transaction with its velocity, the current user's limit, location
    and ``user_cols``, and the rules' flags. With ``FACT_USER_COLS`` the rows
    have the columns of both fact models."""
    cur = current_users(dim).select(
        F.col("user_id").alias("_uid"), *user_cols, "limite_credito", F.col("location").alias("user_location"))
    return rules.evaluate(vel.join(cur, F.col("user_id") == F.col("_uid"), "left"))
