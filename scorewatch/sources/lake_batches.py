"""Lake tables written batch by batch, and their compaction (S3, K2).

A table's batches are folders ``<lake>/<table>/batch=<id>/year=/month=/day=``.
A batch is written over its own folder, so doing it again leaves one copy, and
is complete when Spark has put its ``_SUCCESS`` mark there; readers take complete
batches only.

Small batches make many small files. ``compact`` brings the complete batches
together by date, in files of the size that Spark's adaptive execution aims at,
below ``<lake>/_compacted/<table>`` (``sources.partitioned``). What is published
with them is the last batch they hold: readers take the compacted dates and the
batches after that one. Batch folders are left as they are, so a reader that
began earlier, or a stream over them, goes on undisturbed; ``expire`` removes
the ones that are compacted, when nobody needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewatch.sources.lake import PARTITION_COLS, empty, lake_schema
from scorewatch.sources.partitioned import NULL_PART, PartitionedTable


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def batch_path(lake_root: str, table: str, batch_id: int) -> str:
    return f"{lake_root.rstrip('/')}/{table}/batch={batch_id}"


def is_complete(spark: SparkSession, lake_root: str, table: str, batch_id: int) -> bool:
    files, where = _files(spark, f"{batch_path(lake_root, table, batch_id)}/_SUCCESS")
    return files.exists(where)


def write_batch(rows: DataFrame, lake_root: str, table: str, batch_id: int) -> None:
    """``rows`` of one batch, in place of what an attempt before left."""
    (rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
     .partitionBy(*PARTITION_COLS).parquet(batch_path(lake_root, table, batch_id)))


def complete_batches(spark: SparkSession, lake_root: str, table: str) -> list[int]:
    files, where = _files(spark, f"{lake_root.rstrip('/')}/{table}/batch=*/_SUCCESS")
    found = files.globStatus(where) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def _compacted(spark: SparkSession, lake_root: str, table: str) -> PartitionedTable:
    return PartitionedTable(spark, f"{lake_root.rstrip('/')}/_compacted/{table}", *PARTITION_COLS)


def has_compacted(spark: SparkSession, lake_root: str, table: str) -> bool:
    return _compacted(spark, lake_root, table).version() > 0


def _of_batches(spark: SparkSession, lake_root: str, table: str, batches: list[int]) -> DataFrame:
    if not batches:
        return empty(spark, lake_schema(table))
    return (spark.read.schema(lake_schema(table)).option("basePath", f"{lake_root.rstrip('/')}/{table}")
            .parquet(*[batch_path(lake_root, table, b) for b in batches]).select(*lake_schema(table).fieldNames()))


def _through(held: PartitionedTable) -> int:
    return int(held.note()) if held.note() is not None else -1


def scan_batches(spark: SparkSession, lake_root: str, table: str) -> DataFrame:
    """Every row of the complete batches, with the date columns: from the
    compacted dates and the batches after them."""
    held = _compacted(spark, lake_root, table)
    through = _through(held)
    later = _of_batches(spark, lake_root, table, [b for b in complete_batches(spark, lake_root, table) if b > through])
    done = held.read()
    return later if done is None else done.unionByName(later)


def compact(spark: SparkSession, lake_root: str, table: str) -> int:
    """Compact what is complete; returns the last batch that is in. Only the
    dates that the new batches have rows of are written again."""
    held = _compacted(spark, lake_root, table)
    through = _through(held)
    batches = [b for b in complete_batches(spark, lake_root, table) if b > through]
    if not batches:
        return through
    rows = _of_batches(spark, lake_root, table, batches)
    dates = rows.select(*[F.coalesce(F.col(c), F.lit(NULL_PART)).alias(c) for c in PARTITION_COLS]).distinct().collect()
    touched = ["/".join(d) for d in dates]  # one per date
    before = held.read(touched)
    # Rebalanced by date: small dates share a task, a large one is several files.
    held.replace(rows if before is None else before.unionByName(rows), touched,
                 lambda df: df.hint("rebalance", *PARTITION_COLS), note=str(batches[-1]))
    return batches[-1]


def expire(spark: SparkSession, lake_root: str, table: str) -> list[int]:
    """Remove the batch folders that are compacted; no reader may use them any more."""
    through = _through(_compacted(spark, lake_root, table))
    gone = [b for b in complete_batches(spark, lake_root, table) if b <= through]
    for b in gone:
        files, where = _files(spark, batch_path(lake_root, table, b))
        files.delete(where, True)
    return gone
