"""Slowly changing dimension, type 2, timestamp strategy (SC1-SC5).

A snapshot holds every version of every key with ``dbt_valid_from`` /
``dbt_valid_to``; the open version has ``dbt_valid_to IS NULL``. One step
takes the previous snapshot and the current batch (one row per key):

* key open and batch ``updated_at`` newer than the open ``dbt_valid_from``:
  the open version closes at the new ``updated_at`` and a new one opens;
* key open and not newer: nothing changes;
* key open and missing from the batch (hard delete): it closes at ``as_of``;
* key not open (new, or returning after a delete): a new version opens.

Closed versions pass through untouched (no shuffle); only open versions meet
the batch, in one full outer join on the key (both sides unique per key).
Each joined row yields up to two versions via ``inline`` of a two-element
array, so the join is evaluated once.

Plain Parquet tables have no MERGE, so a step never writes over what it
reads: ``plans.pipeline`` writes each step to a new version folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SCD_COLS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def scd_id(key: Column, updated_at: Column) -> Column:
    """Version key: md5 of the key and updated_at in a fixed text form."""
    return F.md5(F.concat_ws("|", key.cast("string"),
                             F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def _open_version(src: DataFrame, key: str, updated_at: str, cols: Sequence[str]) -> list[Column]:
    return [*[F.col(c) for c in cols],
            scd_id(F.col(key), F.col(updated_at)).alias("dbt_scd_id"),
            F.col(updated_at).alias("dbt_updated_at"),
            F.col(updated_at).alias("dbt_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to")]


def snapshot_initial(batch: DataFrame, key: str = "user_id",
                     updated_at: str = "updated_at") -> DataFrame:
    """First run: every batch row opens a version valid from its updated_at."""
    return batch.select(*_open_version(batch, key, updated_at, batch.columns))


def snapshot_step(prev: DataFrame, batch: DataFrame, as_of: Column, key: str = "user_id",
                  updated_at: str = "updated_at", invalidate_hard_deletes: bool = True) -> DataFrame:
    """Next snapshot from ``prev`` and the current ``batch`` run at ``as_of``."""
    closed = prev.filter(F.col("dbt_valid_to").isNotNull())
    opened = prev.filter(F.col("dbt_valid_to").isNull())
    old, new, joined = _versions(opened, batch, as_of, key, updated_at, invalidate_hard_deletes)
    touched = joined.select(F.inline(F.filter(F.array(old, new), lambda x: x.isNotNull())))
    return closed.unionByName(touched.select(*closed.columns))


def snapshot_changes(opened: DataFrame, batch: DataFrame, as_of: Column, key: str = "user_id",
                     updated_at: str = "updated_at", invalidate_hard_deletes: bool = True) -> DataFrame:
    """Only what a step changes: the open versions that close (with their
    ``dbt_valid_to``) and the versions that open. Nothing for other keys."""
    old, new, joined = _versions(opened, batch, as_of, key, updated_at, invalidate_hard_deletes)
    found = F.filter(F.array(F.when(old["dbt_valid_to"].isNotNull(), old), new), lambda x: x.isNotNull())
    return joined.select(F.inline(found)).select(*batch.columns, *SCD_COLS)


def _versions(opened: DataFrame, batch: DataFrame, as_of: Column, key: str, updated_at: str,
              invalidate_hard_deletes: bool) -> tuple[Column, Column, DataFrame]:
    """The old and the new version of each key after the step, NULL where
    there is none, as columns of the joined frame."""
    cols = list(batch.columns)
    # Presence markers, not key nullness: a NULL key never matches, so its
    # open version is closed as deleted and its batch row opens a new one.
    o = opened.select(*[F.col(c).alias(f"o_{c}") for c in cols + list(SCD_COLS)],
                      F.lit(True).alias("_o"))
    b = batch.select(*[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("_b"))
    j = o.join(b, F.col(f"o_{key}") == F.col(f"b_{key}"), "full_outer")

    has_o = F.col("_o").isNotNull()
    has_b = F.col("_b").isNotNull()
    newer = F.col(f"b_{updated_at}") > F.col("o_dbt_valid_from")
    deleted = has_o & ~has_b
    if not invalidate_hard_deletes:
        deleted = F.lit(False)
    old_valid_to = (F.when(has_o & has_b & newer, F.col(f"b_{updated_at}"))
                    .when(deleted, as_of.cast("timestamp_ntz")))
    old = F.when(has_o, F.struct(
        *[F.col(f"o_{c}").alias(c) for c in cols],
        F.col("o_dbt_scd_id").alias("dbt_scd_id"),
        F.col("o_dbt_updated_at").alias("dbt_updated_at"),
        F.col("o_dbt_valid_from").alias("dbt_valid_from"),
        old_valid_to.alias("dbt_valid_to")))
    new = F.when(has_b & (~has_o | newer), F.struct(
        *[F.col(f"b_{c}").alias(c) for c in cols],
        scd_id(F.col(f"b_{key}"), F.col(f"b_{updated_at}")).alias("dbt_scd_id"),
        F.col(f"b_{updated_at}").alias("dbt_updated_at"),
        F.col(f"b_{updated_at}").alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to")))
    return old, new, j


def snapshot_batches(batches: Sequence[DataFrame], run_times: Sequence[Column],
                     key: str = "user_id", updated_at: str = "updated_at") -> DataFrame:
    """Snapshot of a sequence of batches (first run, then steps), with the
    result of the steps one by one; ``run_times[i]`` is the run time of
    ``batches[i + 1]``."""
    both = batches[0].withColumn("_b", F.lit(0))
    for i, batch in enumerate(batches[1:], 1):
        both = both.unionByName(batch.withColumn("_b", F.lit(i)))
    return snapshot_union(both, run_times, key, updated_at)


def snapshot_union(rows: DataFrame, run_times: Sequence[Column], key: str = "user_id",
                   updated_at: str = "updated_at", batch: str = "_b") -> DataFrame:
    """All versions from one pass over the batches' rows, one row per key and
    ``batch`` (0, 1, ...).

    Within a stretch of batches that all hold the key, a row opens a version if
    it is the first or newer than everything before it in the stretch, and
    closes at the next version's time; the last one closes at the run that
    missed the key, if there was one. A row with a NULL key is a stretch of its
    own. All windows share the key's exchange.
    """
    cols = [c for c in rows.columns if c != batch]
    at = F.col(updated_at)
    per_key = Window.partitionBy(key).orderBy(batch)
    stretch = F.when(F.col(key).isNull(), F.col(batch)).otherwise(F.col(batch) - F.row_number().over(per_key))
    rows = rows.withColumn("_s", stretch)
    along = Window.partitionBy(key, "_s").orderBy(batch)
    whole = Window.partitionBy(key, "_s")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("_first", F.row_number().over(along) == 1)
            .withColumn("_open", F.first(at).over(along)).withColumn("_top", F.max(at).over(before))
            .withColumn("_missed", F.max(batch).over(whole) + 1)
            .filter(F.col("_first") | (F.col("_open").isNotNull() & (at > F.col("_top")))))
    gone = F.lit(None).cast("timestamp_ntz")
    for i, run_at in enumerate(run_times, 1):
        gone = F.when(F.col("_missed") == i, run_at.cast("timestamp_ntz")).otherwise(gone)
    # A version that follows is newer, so its time is never NULL.
    until = F.coalesce(F.lead(at).over(along), gone)
    return rows.select(*_open_version(rows, key, updated_at, cols)[:-1], until.alias("dbt_valid_to"))
