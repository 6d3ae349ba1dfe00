"""End-to-end batch build: raw -> staging -> snapshot -> velocity -> marts ->
data-quality report (K8, T7).

Staging models are temporary views; the two deduplicated ones with several
consumers are written once per build and the views read them. The snapshot,
the intermediate model and the marts are written tables.
The snapshot runs before the marts, so ``dim_users`` always reflects the
current batch.

Published tables (snapshot, intermediate model, marts, report) are
versioned: Parquet has no MERGE or atomic replace, so each build writes a new
folder ``v=<n>`` and then appends one row to a small commit log ``_log``;
readers take the highest committed version. A failed build leaves the
previous versions current; nothing published is overwritten in place.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scorewatch.operators import quality, scd2
from scorewatch.functions.constants import VELOCITY_WINDOWS_MIN
from scorewatch.operators.velocity import choose_buckets, user_transaction_velocity
from scorewatch.plans import marts, staging
from scorewatch.sources.lake import read_raw
from scorewatch.sources.versioned import VersionedTable, publish, read_published

SnapshotStore = VersionedTable


def with_event_date(facts: DataFrame, ts_col: str = "created_at") -> DataFrame:
    return facts.withColumn("event_date", F.to_date(F.col(ts_col)))


def write_by_date(facts: DataFrame, path: str) -> None:
    """Write a fact table (with ``event_date``, see :func:`with_event_date`)
    partitioned by ``event_date`` so time-window queries prune whole days.
    Rows are range-partitioned on (date, id) first: each task writes a
    contiguous run of days, and a hot day is split across several tasks
    instead of landing in one."""
    key = "transaction_id" if "transaction_id" in facts.columns else "event_date"
    (facts.repartitionByRange("event_date", key)
     .write.mode("overwrite").partitionBy("event_date").parquet(path))


def run_snapshot(store: SnapshotStore, stg_users: DataFrame, run_at: Column) -> int:
    prev = store.read()
    snap = scd2.snapshot_initial(stg_users) if prev is None else scd2.snapshot_step(prev, stg_users, run_at)
    return store.commit(snap)


def build_all(spark: SparkSession, raw_root: str, out_root: str, run_at: Column) -> dict[str, str]:
    """Build every model from the raw tables; returns model -> path."""
    out = out_root.rstrip("/")
    raw = {t: read_raw(spark, raw_root, t) for t in ("transactions", "users", "cards", "card_movements")}
    stg = {
        "stg_transactions": staging.stg_transactions(raw["transactions"]),
        "stg_users": staging.stg_users(raw["users"]),
        "stg_cards": staging.stg_cards(raw["cards"]),
        "stg_card_movements": staging.stg_card_movements(raw["card_movements"]),
    }
    # The deduplicated staging models feed several consumers (transactions:
    # velocity and both facts; users: the snapshot): write them once instead
    # of re-running scan + dedup shuffle per consumer. Views stay views.
    for name in ("stg_transactions", "stg_users"):
        publish(spark, f"{out}/staging/{name}", stg[name])
        stg[name] = read_published(spark, f"{out}/staging/{name}")
    for name, df in stg.items():
        df.createOrReplaceTempView(name)

    store = SnapshotStore(spark, f"{out}/snapshots/snap_users_scoring")
    run_snapshot(store, stg["stg_users"], run_at)

    stg_tx = stg["stg_transactions"]
    # Velocity bucket width from the data (one small job): a hot user is split
    # into tasks of bounded size whatever its density. A width chosen for the
    # widest window also serves the alerts' 5-minute window.
    buckets = choose_buckets(stg_tx, "user_id", "created_at", max(VELOCITY_WINDOWS_MIN))
    paths = {"int_user_transaction_velocity": publish(
        spark, f"{out}/intermediate/int_user_transaction_velocity",
        user_transaction_velocity(stg_tx, **buckets))}
    paths["dim_users"] = publish(spark, f"{out}/marts/dim_users", marts.dim_users(store.read()))
    dim = read_published(spark, f"{out}/marts/dim_users")
    paths["fct_transactions"] = publish(spark, f"{out}/marts/fct_transactions",
                                        with_event_date(marts.fct_transactions(stg_tx, dim)), write_by_date)
    paths["fct_fraud_alerts"] = publish(spark, f"{out}/marts/fct_fraud_alerts",
                                        with_event_date(marts.fct_fraud_alerts_from(
                                            stg_tx, read_published(spark, f"{out}/intermediate/int_user_transaction_velocity"), dim)),
                                        write_by_date)

    models = dict(stg)
    roots = {"int_user_transaction_velocity": "intermediate/int_user_transaction_velocity",
             "dim_users": "marts/dim_users", "fct_transactions": "marts/fct_transactions",
             "fct_fraud_alerts": "marts/fct_fraud_alerts"}
    models.update({k: read_published(spark, f"{out}/{r}") for k, r in roots.items()})
    paths["dq_report"] = publish(spark, f"{out}/reports/dq_report",
                                 quality.run_checks(models, quality.MODEL_CHECKS))
    paths["snapshot"] = store.path(store.current_version())
    return paths


PUBLISHED = {
    "dim_users": "marts/dim_users",
    "fct_transactions": "marts/fct_transactions",
    "fct_fraud_alerts": "marts/fct_fraud_alerts",
    "int_user_transaction_velocity": "intermediate/int_user_transaction_velocity",
    "snap_users_scoring": "snapshots/snap_users_scoring",
    "dq_report": "reports/dq_report",
}


def register_tables(spark: SparkSession, out_root: str, database: str = "marts") -> dict[str, str]:
    """Expose the committed version of every published table to Spark SQL as
    ``<database>.<name>`` (external Parquet tables), so SQL written against
    the warehouse runs unchanged on the session. Re-run after each build to
    point the tables at the new versions. Returns name -> location."""
    out = out_root.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    located = {}
    for name, rel in PUBLISHED.items():
        table = VersionedTable(spark, f"{out}/{rel}")
        row = table.latest_commit()
        if row is None:
            continue
        path = table.path(int(row["version"]))
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = " PARTITIONED BY (event_date)" if "event_date" in schema.fieldNames() else ""
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` ({cols}) USING parquet{parts} LOCATION '{path}'")
        if parts:
            # Partition folders (event_date=...) are registered in the catalog.
            spark.catalog.recoverPartitions(f"`{database}`.`{name}`")
        located[name] = path
    return located
