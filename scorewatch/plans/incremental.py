"""Change-driven build (K8): only the dates that changes reach are built again.

``apply`` takes the deliveries since the last run and the users as they are now:

1. the snapshot takes a step; users with a version that opened or closed are
   the changed ones;
2. deliveries meet the staged transactions by id; the earliest of each id stays.
   Dates that gain, lose or change a row are the changed dates;
3. velocity is built again for these dates and the ones after them, as far as
   the widest window reaches, from their rows and the window before them;
4. both facts are built again for these dates and for all dates with
   transactions of a changed user (the rules look at the current user);
5. the hourly rollup is built again for the same dates.

Every table is partitioned by ``event_date`` (``sources.partitioned``); other
dates keep their files. What a run means to do is published before it touches a
table, and done is recorded after the last one: the next run after a failure
takes the open dates and users along, so it need not know where it stopped.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scorewatch.functions.constants import VELOCITY_WINDOWS_MIN
from scorewatch.operators.dedup import keep_earliest
from scorewatch.operators.velocity import user_transaction_velocity, velocity_for_dates
from scorewatch.plans import marts, rollup, staging
from scorewatch.plans.pipeline import with_event_date
from scorewatch.plans.snapshot_log import BUCKETS, SnapshotLog
from scorewatch.sources.partitioned import PartitionedTable, part_text
from scorewatch.sources.versioned import VersionedTable

DATE = "event_date"
_DONE = "snapshot long, planned long"
TABLES = ("stg_transactions", "int_user_transaction_velocity", "fct_transactions", "fct_fraud_alerts", "alerts_hourly")


class IncrementalBuild:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, root = spark, root.rstrip("/")
        self.snapshot = SnapshotLog(spark, f"{root}/snap_users_scoring", buckets)
        self.tables = {t: PartitionedTable(spark, f"{root}/{t}", DATE) for t in TABLES}
        self.incoming = VersionedTable(spark, f"{root}/work/incoming")
        self.planned = VersionedTable(spark, f"{root}/work/planned")  # dates a run will touch
        self.done = VersionedTable(spark, f"{root}/work/done")

    def apply(self, deliveries: DataFrame, raw_users: DataFrame, run_at: Column) -> list[dt.date | None]:
        """One run; returns the dates whose facts were built again."""
        seen, open_dates = self._last()["snapshot"], self._open_dates()
        self.snapshot.step(staging.stg_users(raw_users), run_at)

        changed = self._plan_staged(deliveries) | open_dates
        self.planned.commit(self._as_table(changed))
        self._replace_staged(changed)
        staged = self.tables["stg_transactions"].read()

        velocity = changed | self._following(changed)
        self._write("int_user_transaction_velocity", velocity_for_dates(staged, sorted_dates(velocity)), velocity)

        users = self.snapshot.changed_keys(seen)
        of_users = staged.select("user_id", DATE).join(users, "user_id", "left_semi").select(DATE).distinct()
        dates = velocity | {r[0] for r in of_users.collect()}  # one row per date
        self._write_facts(dates)
        self.done.commit(self.spark.createDataFrame([(self.snapshot.version(), self.planned.current_version())], _DONE))
        return sorted_dates(dates & self._dates())

    # which dates ---------------------------------------------------------
    def _as_table(self, dates: Iterable[dt.date | None]) -> DataFrame:
        return self.spark.createDataFrame([(d,) for d in sorted_dates(dates)], f"{DATE} date")

    def _last(self) -> dict[str, int]:
        """Versions of the snapshot and of the plans that the tables hold."""
        last = self.done.read()
        return {"snapshot": 0, "planned": 0} if last is None else last.first().asDict()

    def _open_dates(self) -> set[dt.date | None]:
        """Dates of runs that didn't end."""
        runs = range(self._last()["planned"] + 1, (self.planned.current_version() or 0) + 1)
        return {r[0] for n in runs for r in self.planned.read(n).collect()}

    def _dates(self) -> set[dt.date | None]:
        return {r[0] for r in self.tables["stg_transactions"].read().select(DATE).distinct().collect()}

    @staticmethod
    def _following(dates: set[dt.date | None]) -> set[dt.date]:
        reach = math.ceil(max(VELOCITY_WINDOWS_MIN) / 1440)
        return {d + dt.timedelta(days=x) for d in dates if d is not None for x in range(1, reach + 1)}

    # staged transactions -------------------------------------------------
    def _plan_staged(self, deliveries: DataFrame) -> set[dt.date | None]:
        """Publish the rows that take a place in the staged table; the dates
        they come to, and those of the rows they replace."""
        fresh = staging.stg_transactions(deliveries)
        held = self.tables["stg_transactions"].read()
        if held is not None:
            key = F.col("transaction_id").eqNullSafe(F.col("_id"))
            same = held.drop(DATE).join(fresh.select(F.col("transaction_id").alias("_id")), key, "left_semi")
            both = same.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True)))
            fresh = (keep_earliest(both, "transaction_id", "created_at", [c for c in same.columns if c not in (
                "transaction_id", "created_at")] + ["_fresh"]).filter("_fresh").drop("_fresh"))
        self.incoming.commit(with_event_date(fresh))
        incoming = self.incoming.read()
        dates = {r[0] for r in incoming.select(DATE).distinct().collect()}
        if held is not None:
            dates |= {r[0] for r in self._replaced(held, incoming, "left_semi").select(DATE).distinct().collect()}
        return dates

    @staticmethod
    def _replaced(held: DataFrame, incoming: DataFrame, how: str) -> DataFrame:
        ids = incoming.select(F.col("transaction_id").alias("_id"))
        return held.join(ids, F.col("transaction_id").eqNullSafe(F.col("_id")), how)

    def _replace_staged(self, dates: set[dt.date | None]) -> None:
        table, incoming = self.tables["stg_transactions"], self.incoming.read()
        held = table.read(part_text(dates))
        self._write("stg_transactions", incoming if held is None else
                    self._replaced(held, incoming, "left_anti").unionByName(incoming), dates)

    # writing -------------------------------------------------------------
    def _write(self, name: str, rows: DataFrame, dates: Iterable[dt.date | None]) -> None:
        """By date and time: a hot day is several files, and a file is a stretch
        of time, so that reading the end of a day skips the rest."""
        order = [DATE] + ["created_at" if "created_at" in rows.columns else "hora"]
        self.tables[name].replace(rows, part_text(dates), lambda df: df.repartitionByRange(*order).sortWithinPartitions(*order))

    def _write_facts(self, dates: set[dt.date | None]) -> None:
        parts = part_text(dates)
        tx = self.tables["stg_transactions"].read(parts)
        dim = marts.dim_users(self.snapshot.current())
        self._write("fct_transactions", with_event_date(marts.fct_transactions(tx, dim)), dates)
        velocity = self.tables["int_user_transaction_velocity"].read(parts)
        self._write("fct_fraud_alerts", with_event_date(marts.fct_fraud_alerts_from(tx, velocity, dim)), dates)
        self._write("alerts_hourly", rollup.hourly(self.tables["fct_fraud_alerts"].read(parts)), dates)


def sorted_dates(dates: Iterable[dt.date | None]) -> list[dt.date | None]:
    return sorted(dates, key=lambda d: (d is None, d or dt.date.min))
