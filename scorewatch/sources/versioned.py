"""Tables published as version folders with a commit log.

Parquet has no atomic replace, so a write goes to a new folder ``v=<n>`` and is
then recorded in a small log; readers take the highest recorded version. A
failed write leaves the previous version current.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_LOG_SCHEMA = T.StructType([T.StructField("version", T.LongType()),
                            T.StructField("committed_at", T.TimestampNTZType()),
                            T.StructField("schema_json", T.StringType())])


class VersionedTable:
    """A table published as version folders ``<root>/v=<n>`` plus a commit
    log ``<root>/_log`` (one small row per commit: version, time, schema)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def latest_commit(self, version: int | None = None):
        """The log row of ``version`` (default: the highest), or None."""
        try:
            log = self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.root}/_log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if version is not None:
            log = log.filter(F.col("version") == version)
        return log.orderBy(F.col("version").desc()).select("version", "schema_json").first()

    def current_version(self) -> int | None:
        row = self.latest_commit()
        return None if row is None else int(row["version"])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The committed version, read with its recorded schema (an empty
        version, e.g. a partitioned write of no rows, has no files)."""
        row = self.latest_commit(version)
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema_json"]))
        return self.spark.read.schema(schema).parquet(self.path(int(row["version"])))

    def commit(self, df: DataFrame, writer: Callable[[DataFrame, str], None] | None = None) -> int:
        """Write the next version, then record it. A folder left by a failed
        attempt is not in the log, so a retry may overwrite it; readers only
        ever see logged versions. One writer per table."""
        v = (self.current_version() or 0) + 1
        if writer is None:
            df.write.mode("overwrite").parquet(self.path(v))
        else:
            writer(df, self.path(v))
        now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
        (self.spark.createDataFrame([(v, now, df.schema.json())], _LOG_SCHEMA)
         .coalesce(1).write.mode("append").parquet(f"{self.root}/_log"))
        return v


def publish(spark: SparkSession, root: str, df: DataFrame,
            writer: Callable[[DataFrame, str], None] | None = None) -> str:
    """Commit ``df`` as the next version of the table at ``root``; returns
    the version's folder."""
    table = VersionedTable(spark, root)
    return table.path(table.commit(df, writer))


def read_published(spark: SparkSession, root: str) -> DataFrame:
    df = VersionedTable(spark, root).read()
    if df is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return df
