"""Staging models over the raw tables (P1-P4): rename, type, clean, dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scorewatch.functions.text import blank_to_null
from scorewatch.operators.dedup import keep_earliest, keep_latest
from scorewatch.sources.schemas import MONEY


def stg_transactions(raw: DataFrame) -> DataFrame:
    """One row per transaction id: the earliest delivery."""
    typed = raw.select(
        F.col("id").alias("transaction_id"), "user_id",
        F.col("amount").cast(MONEY).alias("amount_usd"),
        blank_to_null("merchant_category").alias("merchant_category"),
        blank_to_null("location").alias("location"),
        F.coalesce(F.col("is_flagged_fraud"), F.lit(False)).alias("is_flagged_fraud"),
        "created_at")
    return keep_earliest(typed, "transaction_id", "created_at")


def stg_users(raw: DataFrame, batch: str | None = None) -> DataFrame:
    """One row per user: the latest state (P2); per user and batch if
    ``batch`` names the column of the snapshot run a row belongs to."""
    typed = raw.select(
        F.col("id").alias("user_id"),
        blank_to_null("nombre").alias("nombre"),
        F.col("scoring_crediticio").cast("int").alias("scoring_crediticio"),
        F.col("limite_credito").cast(MONEY).alias("limite_credito"),
        F.lower(blank_to_null("status_riesgo")).alias("status_riesgo"),
        blank_to_null("location").alias("location"),
        "updated_at", *([batch] if batch else []))
    return keep_latest(typed, ["user_id", batch] if batch else "user_id", "updated_at")


def stg_cards(raw: DataFrame) -> DataFrame:
    """One row per card: the latest ingest (P3). Holds no PAN or CVV."""
    typed = raw.select(
        "card_id", "user_id", "pan_last_masked",
        blank_to_null("card_type").alias("card_type"),
        "cardholder_masked",
        blank_to_null("exp_date").alias("exp_date"),
        "ingested_at")
    return keep_latest(typed, "card_id", "ingested_at")


def stg_card_movements(raw: DataFrame) -> DataFrame:
    """Typed movements from the daily CSV; no dedup."""
    return raw.select(
        F.col("id").alias("source_id"), "card_id",
        F.col("date").cast("timestamp_ntz").alias("movement_date"),
        F.col("amount").cast(MONEY).alias("amount_usd"),
        blank_to_null("merchant_category").alias("merchant_category"),
        blank_to_null("location").alias("location"),
        "source_date")
