"""The models over one set of test tables, and the registered queries.

``Warehouse(spark, sf_dir)`` derives the raw tables (``sources.testdata``)
and builds staging, snapshot, velocity, marts and served queries lazily:
nothing runs until an action. ``QUERIES`` maps each registered name to a
``(spark, sf_dir) -> DataFrame`` callable.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scorewatch.functions import constants as K
from scorewatch.functions.timecols import ntz
from scorewatch.operators import quality, rules, scd2
from scorewatch.operators.dedup import keep_earliest, keep_latest
from scorewatch.operators.velocity import user_transaction_velocity, with_velocity
from scorewatch.plans import marts, rollup, serving, staging
from scorewatch.session import configure
from scorewatch.sources import testdata as td
from scorewatch.sources.lake import lake_to_raw, raw_movements
from scorewatch.streaming import cards as card_jobs
from scorewatch.streaming import decode, ingest

# --- fixed values: parameters of the registered served queries -----------
AS_OF = "2024-01-01 06:00:00"        # "now" of the served queries
AS_OF_MONTH = "2024-01-30 12:00:00"  # the same on the events' own 30 days
CARD_STAMP = "2024-01-02 10:11:12"   # ingest time of the stamped cards
NONE_EVERY = 71                      # raw load check: every 71st location is the text None
SUMMARY_HOURS = 3
RADAR_MINUTES = 5
ALERT_USER = 3
HISTORY_USER = 57                    # changed in batch 2, deleted in batch 3 (sf0.01 and up)
CORRUPT_EVERY = 101                  # decode check: every 101st event has a bad created_at
# -------------------------------------------------------------------------

class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, compression: int = td.TX_COMPRESSION):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.compression = compression

    # raw -----------------------------------------------------------------
    @cached_property
    def raw_transactions(self) -> DataFrame:
        return td.transactions_raw(self.spark, self.sf_dir, self.compression)

    @cached_property
    def user_base(self) -> DataFrame:
        return td.all_users(self.spark, self.sf_dir)

    def raw_users(self, batch: int) -> DataFrame:
        return td.users_raw(self.spark, self.sf_dir, batch, self.user_base)

    @cached_property
    def card_feed(self) -> DataFrame:
        return td.card_feed(self.spark, self.sf_dir, self.user_base)

    @cached_property
    def raw_cards(self) -> DataFrame:
        return card_jobs.anonymize(self.card_feed)

    @cached_property
    def raw_card_movements(self) -> DataFrame:
        landing = td.card_movements_landing(self.spark, self.sf_dir).withColumn(
            "amount", F.col("amount").cast("decimal(15,2)"))
        return raw_movements(landing)

    # staging -------------------------------------------------------------
    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw_transactions)

    def stg_users_batch(self, batch: int) -> DataFrame:
        return staging.stg_users(self.raw_users(batch))

    @cached_property
    def stg_users(self) -> DataFrame:
        allb = self.raw_users(1).unionByName(self.raw_users(2)).unionByName(self.raw_users(3))
        return staging.stg_users(allb)

    @cached_property
    def stg_cards(self) -> DataFrame:
        return staging.stg_cards(self.raw_cards)

    @cached_property
    def stg_card_movements(self) -> DataFrame:
        return staging.stg_card_movements(self.raw_card_movements)

    # snapshot and marts --------------------------------------------------
    def snapshot(self, batches: int = 3) -> DataFrame:
        """All batches in one pass: brought together by user once, which also
        serves the deduplication per batch."""
        raw = self.raw_users(1).withColumn("_b", F.lit(1))
        for b in range(2, batches + 1):
            raw = raw.unionByName(self.raw_users(b).withColumn("_b", F.lit(b)))
        stg = staging.stg_users(raw.repartition("id"), batch="_b")
        return scd2.snapshot_union(stg.withColumn("_b", F.col("_b") - 1),
                                   [ntz(td.BATCH_RUN_AT[b]) for b in range(2, batches + 1)])

    @cached_property
    def dim_users(self) -> DataFrame:
        return marts.dim_users(self.snapshot(3))

    @cached_property
    def velocity(self) -> DataFrame:
        return user_transaction_velocity(self.stg_transactions)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return marts.fct_transactions(self.stg_transactions, self.dim_users)

    @cached_property
    def fct_transactions_asof(self) -> DataFrame:
        return marts.fct_transactions_asof(self.stg_transactions, self.dim_users)

    @cached_property
    def fct_fraud_alerts(self) -> DataFrame:
        return marts.fct_fraud_alerts(self.stg_transactions, self.dim_users)

    @cached_property
    def alerts_hourly(self) -> DataFrame:
        return rollup.hourly(self.fct_fraud_alerts)

    @cached_property
    def current(self) -> DataFrame:
        return marts.current_users(self.dim_users)

    #: model -> attribute; a model is built only when a check names it
    MODELS = {m: m for m in ("stg_transactions", "stg_users", "stg_cards", "stg_card_movements", "dim_users",
                             "fct_transactions", "fct_fraud_alerts")} | {"int_user_transaction_velocity": "velocity"}

    def model(self, name: str) -> DataFrame:
        return getattr(self, self.MODELS[name])

    def dq(self) -> DataFrame:
        """The report over all models. The velocity model has the staged
        transactions' rows, and both facts have the same ones joined to the
        current user: each pair is one frame."""
        staged = with_velocity(self.stg_transactions)
        facts = marts.facts_and_alerts(staged, self.dim_users, marts.FACT_USER_COLS)
        shared = {"stg_transactions": staged, "int_user_transaction_velocity": staged,
                  "fct_transactions": facts, "fct_fraud_alerts": facts}
        models = {c.model: shared[c.model] if c.model in shared else self.model(c.model) for c in quality.MODEL_CHECKS}
        return quality.run_checks(models, quality.MODEL_CHECKS)

    # transactions joined to the current user, for the rules that need one
    def with_user(self, *cols: str) -> DataFrame:
        cur = self.current.select(F.col("user_id").alias("_uid"), *[F.col(c).alias(f"user_{c}") for c in cols])
        return self.stg_transactions.join(cur, F.col("user_id") == F.col("_uid"), "left")

    def soiled(self, name: str) -> DataFrame:
        """A model with repeated rows and with copies that break its tests."""
        df = self.model(name)
        key, changes = SOILED[name]
        kinds = [(REPEAT_EVERY, {}), *changes]
        copies = F.array(F.lit(0), *[F.when(F.col(key) % every == 0, i) for i, (every, _) in enumerate(kinds, 1)])
        out = df.withColumn("_copy", F.explode(F.array_compact(copies)))
        for i, (_, columns) in enumerate(kinds, 1):
            out = out.withColumns({c: F.when(F.col("_copy") == i, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c))
                                   for c, v in columns.items()})
        return out.drop("_copy")

    def dq_soiled(self, test: str) -> DataFrame:
        checks = [c for c in (*quality.MODEL_CHECKS, STATUS_CHECK) if c.test == test]
        return quality.run_checks({c.model: self.soiled(c.model) for c in checks}, checks)

    # decode round trip ---------------------------------------------------
    def decoded_transactions(self) -> DataFrame:
        lake = td.transactions_lake(self.spark, self.sf_dir)
        wire = decode.encode_transactions(lake).withColumn(
            "value", F.when(F.col("key").cast("long") % CORRUPT_EVERY == 0,
                            F.regexp_replace("value", r'"created_at":"[^"]*"', '"created_at":"junk"'))
            .otherwise(F.col("value")))
        return decode.decode_transactions(wire).drop("key")

    def decoded_users(self) -> DataFrame:
        """Every batch, each third limit unreadable (kept as NULL)."""
        lake = td.users_lake(self.spark, self.sf_dir, 1, self.user_base)
        for b in (2, 3):
            lake = lake.unionByName(td.users_lake(self.spark, self.sf_dir, b, self.user_base))
        wire = decode.encode_users(lake).withColumn(
            "value", F.when(F.col("key").cast("long") % 3 == 0,
                            F.regexp_replace("value", r'"limite_credito":"[^"]*"', '"limite_credito":"n/a"'))
            .otherwise(F.col("value")))
        return decode.decode_users(wire).drop("key")

    def unwrapped(self) -> DataFrame:
        events = td.change_events(td.transactions_lake(self.spark, self.sf_dir))
        return decode.decode_transactions(decode.unwrap_cdc(events)).drop("key")

    def lake_rows(self) -> DataFrame:
        route, = ingest.select_topics("transactions")
        wire = decode.encode_transactions(td.transactions_lake(self.spark, self.sf_dir))
        return ingest.to_lake_rows(wire.withColumn("topic", F.lit(route.topic)), route)

    def raw_typed(self) -> DataFrame:
        lake = td.transactions_lake(self.spark, self.sf_dir).withColumn(
            "location", F.when(F.col("id") % NONE_EVERY == 0, "None").otherwise(F.col("location")))
        return lake_to_raw(lake, "transactions")


#: Which rows of a model are repeated, and for each model its key
#: and the copies that break its tests (every n-th key: changed columns).
REPEAT_EVERY = 13
_NO_ID = {"transaction_id": None}
SOILED = {
    "stg_transactions": ("transaction_id", [(17, _NO_ID | {"user_id": None, "created_at": None})]),
    "stg_users": ("user_id", [(17, {"user_id": None, "scoring_crediticio": None})]),
    "stg_cards": ("card_id", [(17, {"card_id": None, "user_id": None})]),
    "stg_card_movements": ("source_id", [(17, {"source_id": None})]),
    "int_user_transaction_velocity": ("transaction_id", [(17, _NO_ID), (19, {"cnt_5min": 0})]),
    "dim_users": ("user_id", [(17, {"user_sk": None, "scoring_crediticio": None}), (19, {"scoring_crediticio": 299}),
                              (23, {"scoring_crediticio": 851}), (29, {"status_riesgo": "otro"})]),
    "fct_transactions": ("transaction_id", [(17, _NO_ID | {"amount_usd": None}), (19, {"amount_usd": -1})]),
    "fct_fraud_alerts": ("transaction_id", [(17, _NO_ID | {"is_fraud_alert": None})]),
}
STATUS_CHECK = quality.Check("dim_users", "status_riesgo", "accepted_values", values=("bajo", "medio", "alto"))


def _month(fn: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """On the events' own 30 days, longer than the served limits."""
    return lambda spark, sf_dir: fn(Warehouse(spark, sf_dir, compression=1))


def _w(fn: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Warehouse(spark, sf_dir))


def _asof(w: Warehouse):
    return ntz(AS_OF)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # flagship and marts
    "fct_fraud_alerts": _w(lambda w: w.fct_fraud_alerts),
    "fct_transactions": _w(lambda w: w.fct_transactions),
    "fct_transactions_asof": _w(lambda w: w.fct_transactions_asof),
    "fct_transactions_asof_carry": _w(lambda w: marts.fct_transactions_asof(
        w.stg_transactions, w.dim_users, strategy="carry", bucket_seconds=1800)),
    "dim_users": _w(lambda w: w.dim_users),
    "user_transaction_velocity": _w(lambda w: w.velocity),
    "velocity_probe": _w(lambda w: user_transaction_velocity(w.stg_transactions, strategy="probe", bucket_seconds=600)),
    "velocity_instants": _w(lambda w: user_transaction_velocity(w.stg_transactions, strategy="instants")),
    "velocity_count": _w(lambda w: with_velocity(
        w.stg_transactions.select("user_id", "transaction_id", "created_at", "amount_usd"),
        windows_min=(5,), metrics=("cnt",)).select("transaction_id", "cnt_5min")),
    "velocity_sum": _w(lambda w: with_velocity(
        w.stg_transactions.select("user_id", "transaction_id", "created_at", "amount_usd"),
        windows_min=(60,), metrics=("sum",)).select("transaction_id", "sum_60min")),
    # staging and dedup
    "stg_transactions": _w(lambda w: w.stg_transactions),
    "stg_users": _w(lambda w: w.stg_users),
    "stg_cards": _w(lambda w: w.stg_cards),
    "stg_card_movements": _w(lambda w: w.stg_card_movements),
    "dedup_earliest": _w(lambda w: keep_earliest(w.raw_transactions, "id", "created_at")),
    "dedup_latest": _w(lambda w: keep_latest(w.raw_cards, "card_id", "ingested_at")),
    "movement_surrogate_id": _w(lambda w: w.raw_card_movements),
    # cards
    "anonymize_cards": _w(lambda w: w.raw_cards),
    "explode_card_pages": _w(lambda w: card_jobs.explode_pages(td.card_pages(w.card_feed, K.CARD_PAGE_SIZE))),
    "card_stamp": _w(lambda w: card_jobs.anonymize(w.card_feed.drop("ingested_at"), ntz(CARD_STAMP))),
    "encode_card_events": _w(lambda w: card_jobs.encode_card_events(w.raw_cards)),
    # decode
    "decode_transactions": _w(lambda w: w.decoded_transactions()),
    "decode_users": _w(lambda w: w.decoded_users()),
    "decode_cards": _w(lambda w: decode.decode_cards(card_jobs.encode_card_events(w.raw_cards)).drop("key")),
    "cdc_unwrap": _w(lambda w: w.unwrapped()),
    "lake_partition_parts": _w(lambda w: w.lake_rows()),
    "raw_load_typed": _w(lambda w: w.raw_typed()),
    # snapshot
    "scd2_initial": _w(lambda w: w.snapshot(1)),
    "scd2_snapshot": _w(lambda w: w.snapshot(3)),
    "scd2_hard_delete": _w(lambda w: w.snapshot(3).withColumn(
        "_open", F.max(F.col("dbt_valid_to").isNull()).over(Window.partitionBy("user_id"))).filter("NOT _open").drop("_open")),
    # rules
    "rule_high_amount": _w(lambda w: w.stg_transactions.select(
        "transaction_id", rules.high_amount(F.col("amount_usd")).alias("alert_high_amount"))),
    "rule_limit_exceeded": _w(lambda w: w.with_user("limite_credito").select(
        "transaction_id", rules.limit_exceeded(F.col("amount_usd"), F.col("user_limite_credito")).alias("alert_limit_exceeded"))),
    "rule_velocity": _w(lambda w: with_velocity(
        w.stg_transactions.select("user_id", "transaction_id", "created_at", "amount_usd"),
        windows_min=(5,), metrics=("cnt",)).select("transaction_id", rules.velocity(F.col("cnt_5min")).alias("alert_velocity"))),
    "rule_location_shift": _w(lambda w: w.with_user("location").select(
        "transaction_id", rules.location_shift(F.col("location"), F.col("user_location")).alias("alert_location_shift"))),
    "rule_source_flag": _w(lambda w: w.stg_transactions.select(
        "transaction_id", rules.source_flag(F.col("is_flagged_fraud")).alias("alert_source_flag"))),
    "risk_band_check": _w(lambda w: rules.risk_band_check(w.dim_users)),
    # served queries
    "credit_score_history": _w(lambda w: serving.credit_score_history(w.dim_users)),
    "credit_score_current": _w(lambda w: serving.credit_score_current(w.dim_users)),
    "credit_score_user": _w(lambda w: serving.credit_score_history(w.dim_users, [HISTORY_USER])),
    "credit_score_current_user": _w(lambda w: serving.credit_score_current(w.dim_users, [ALERT_USER])),
    "fraud_alerts_active": _w(lambda w: serving.active_alerts(w.fct_fraud_alerts)),
    "fraud_alerts_user": _w(lambda w: serving.active_alerts(w.fct_fraud_alerts, limit=K.ALERTS_LIMIT_MAX,
                                                            user_id=ALERT_USER)),
    "alerts_hourly": _month(lambda w: w.alerts_hourly),
    "fraud_summary_hourly": _w(lambda w: rollup.fraud_summary(w.alerts_hourly, _asof(w), SUMMARY_HOURS)),
    "fraud_summary_24h": _month(lambda w: rollup.fraud_summary(w.alerts_hourly, ntz(AS_OF_MONTH))),
    "fraud_pct_by_hour": _month(lambda w: rollup.fraud_pct_by_hour(w.alerts_hourly)),
    "fraud_pct_by_day": _month(lambda w: rollup.fraud_pct_by_day(w.alerts_hourly)),
    "score_distribution": _w(lambda w: serving.score_distribution(w.dim_users)),
    "alert_feed": _w(lambda w: serving.alert_feed(w.fct_fraud_alerts)),
    "alert_radar_5min": _w(lambda w: serving.alert_feed(w.fct_fraud_alerts, as_of=_asof(w),
                                                        minutes=RADAR_MINUTES)),
    "alerts_by_rule": _w(lambda w: rollup.alerts_by_rule(w.alerts_hourly)),
    # data quality
    "dq_report": _w(lambda w: w.dq()),
    "dq_not_null": _w(lambda w: w.dq_soiled("not_null")),
    "dq_unique": _w(lambda w: w.dq_soiled("unique")),
    "dq_between": _w(lambda w: w.dq_soiled("between")),
    "dq_accepted_values": _w(lambda w: w.dq_soiled("accepted_values")),
    "dq_source": _w(lambda w: quality.run_checks(
        {"raw_users": w.raw_users(1).unionByName(w.raw_users(2)).unionByName(w.raw_users(3)),
         "raw_transactions": w.raw_transactions}, quality.SOURCE_CHECKS)),
    "dq_no_pii": _w(lambda w: quality.pii_findings(w.raw_cards)),
    "dq_pii_raw_feed": _w(lambda w: quality.pii_findings(w.card_feed, "card_feed")),
    "dq_relationship": _w(lambda w: quality.relationship_check(
        "stg_transactions", w.stg_transactions, w.stg_users_batch(3), "user_id", "user_id")),
}
