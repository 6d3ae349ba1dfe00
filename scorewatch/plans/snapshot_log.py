"""The score snapshot on disk, append-only (SC1-SC5), and lookups by user (Q1, Q2).

Three tables below one root:

* ``open``: the open version of each user, partitioned by a hash bucket of the
  user; a step rewrites the buckets in which a version opens or closes;
* ``changes``: what a step closed and opened, one partition per run, never
  rewritten. Its closed rows are the history;
* ``history``: closed versions of earlier runs, by bucket. ``compact`` moves
  runs there, so that a lookup doesn't open a file per run.

What a step writes grows with the versions that change, not with the history.
The version of ``open`` is the commit point: readers see the closed rows of runs
up to it, and a step that failed before it is done again under the same number.

A user's rows are in one bucket of ``open`` and of ``history`` (one file each, as
a bucket is written by one task) and in the runs since the last ``compact``.
Files are sorted by user and carry Parquet bloom filters on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scorewatch.operators import scd2
from scorewatch.sources.partitioned import PartitionedTable, part_text

BUCKETS = 64
_BUCKET = "bucket"


class SnapshotLog:
    """``buckets`` holds for the life of the table; it is read back from it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, key: str = "user_id",
                 updated_at: str = "updated_at"):
        self.spark, self.root, self.key, self.updated_at = spark, root.rstrip("/"), key, updated_at
        self.open = PartitionedTable(spark, f"{self.root}/open", _BUCKET)
        self.changes = PartitionedTable(spark, f"{self.root}/changes", "run")
        self.history = PartitionedTable(spark, f"{self.root}/history", _BUCKET)
        recorded = self.open.note()
        self.buckets = int(recorded) if recorded else buckets
        self._options = {f"parquet.bloom.filter.enabled#{key}": "true"}

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _clustered(self, df: DataFrame) -> DataFrame:
        return df.repartition(_BUCKET).sortWithinPartitions(_BUCKET, self.key)

    def _write_open(self, rows: DataFrame, touched: Sequence[str]) -> int:
        rows = rows.withColumn(_BUCKET, self._bucket(F.col(self.key)))
        return self.open.replace(rows, touched, self._clustered, str(self.buckets), self._options)

    def version(self) -> int:
        """The last complete run, 0 before the first."""
        return self.open.version()

    def step(self, batch: DataFrame, as_of: Column) -> int:
        """Bring the snapshot up to ``batch`` (one row per user), run at ``as_of``."""
        n = self.version() + 1
        if n == 1:
            return self._write_open(scd2.snapshot_initial(batch, self.key, self.updated_at), ())
        opened = self.open.read().drop(_BUCKET)
        found = scd2.snapshot_changes(opened, batch, as_of, self.key, self.updated_at).withColumn("run", F.lit(n))
        self.changes.replace(found, part_text([n]), lambda df: df.sortWithinPartitions(self.key), options=self._options)
        found = self.changes.read(part_text([n])).drop("run")
        touched = part_text(r[0] for r in found.select(self._bucket(F.col(self.key))).distinct().collect())
        gone = found.filter(F.col("dbt_valid_to").isNotNull()).select(
            F.col(self.key).alias("_k"), F.col("dbt_valid_from").alias("_f"))
        stay = self.open.read(touched).drop(_BUCKET).join(
            gone, F.col(self.key).eqNullSafe(F.col("_k")) & F.col("dbt_valid_from").eqNullSafe(F.col("_f")), "left_anti")
        return self._write_open(stay.unionByName(found.filter(F.col("dbt_valid_to").isNull())), touched)

    def _through(self) -> int:
        """The last run whose closed versions are in ``history``."""
        return int(self.history.note() or 0)

    def _recent(self, after: int, upto: int) -> DataFrame | None:
        """Closed versions of the runs after ``after``, up to ``upto``."""
        runs = [p for p in self.changes.folders() if after < int(p) <= upto]
        return self.changes.read(runs).filter(F.col("dbt_valid_to").isNotNull()).drop("run") if runs else None

    def compact(self) -> int:
        """Move the closed versions of all runs to ``history``. A failure leaves
        it as it was; the runs stay where they are, unread."""
        through, version = self._through(), self.version()
        recent = self._recent(through, version)
        if recent is None:
            return through
        recent = recent.withColumn(_BUCKET, self._bucket(F.col(self.key)))
        touched = part_text(r[0] for r in recent.select(_BUCKET).distinct().collect())
        held = self.history.read(touched)
        rows = recent if held is None else held.unionByName(recent)
        self.history.replace(rows, touched, self._clustered, str(version), self._options)
        return version

    def current(self) -> DataFrame:
        """The open versions."""
        return self.open.read().drop(_BUCKET)

    def read(self) -> DataFrame:
        """Every version, open and closed."""
        return self._all(self.open.read(), self.history.read())

    def _all(self, opened: DataFrame, history: DataFrame | None) -> DataFrame:
        out = opened.drop(_BUCKET)
        recent = self._recent(self._through(), self.version())
        for part in (history.drop(_BUCKET) if history is not None else None, recent):
            out = out if part is None else out.unionByName(part)
        return out

    def of_users(self, users: Sequence[int], history: bool = True) -> DataFrame:
        """The versions of some users (the open ones only if not ``history``).
        Only their buckets are opened, and the runs since the last ``compact``."""
        if not users:
            return (self.read() if history else self.current()).limit(0)
        # Constant for the planner, so the scan's partitions are pruned.
        mine = F.col(_BUCKET).isin(*[self._bucket(F.lit(u).cast("long")) for u in users])
        wanted = F.col(self.key).isin(list(users))
        opened = self.open.read().filter(mine & wanted)
        if not history:
            return opened.drop(_BUCKET)
        held = self.history.read()
        return self._all(opened, None if held is None else held.filter(mine)).filter(wanted)

    def changed_keys(self, after: int) -> DataFrame:
        """Keys with a version that opened or closed in a run after ``after``;
        every key if that covers the first run."""
        if after < 1:
            return self.read().select(self.key).distinct()
        runs = [p for p in self.changes.folders() if after < int(p) <= self.version()]
        return (self.changes.read(runs) if runs else self.current().limit(0)).select(self.key).distinct()
