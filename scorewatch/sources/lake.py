"""Lake scans and the full-refresh raw load.

The lake holds one folder per table, hive-partitioned by event date
(``year=YYYY/month=MM/day=DD``). Reads use the explicit lake schema; the
partition columns stay available for pruning (``where year = '2024'``) and
are dropped only when the raw table is written.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scorewatch.operators.surrogate import ranged_id
from scorewatch.sources.landing import scan_landing_csv
from scorewatch.sources.schemas import LAKE, RAW, conform
from scorewatch.sources.versioned import VersionedTable, publish

log = logging.getLogger(__name__)

PARTITION_COLS = ("year", "month", "day")
RAW_TABLES = ("transactions", "users", "cards", "card_movements")
MOVEMENT_ORDER = ("source_date", "card_id", "date", "amount", "merchant_category", "location")


def lake_schema(table: str) -> T.StructType:
    s = T.StructType(list(LAKE[table].fields))
    for p in PARTITION_COLS:
        s = s.add(p, T.StringType())
    return s


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def scan_lake(spark: SparkSession, lake_root: str, table: str) -> DataFrame:
    """All rows of ``<lake_root>/<table>``, of a streaming sink's files or of
    the batches of a fan-out (``sources.lake_batches``); a missing folder logs a
    warning and gives an empty frame with the same schema."""
    schema = lake_schema(table)
    from scorewatch.sources import lake_batches
    if lake_batches.complete_batches(spark, lake_root, table) or lake_batches.has_compacted(spark, lake_root, table):
        return lake_batches.scan_batches(spark, lake_root, table)
    try:
        return spark.read.schema(schema).parquet(f"{lake_root.rstrip('/')}/{table}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        log.warning("no lake files for %s under %s", table, lake_root)
        return empty(spark, schema)


def raw_movements(landing: DataFrame) -> DataFrame:
    """Landing rows to ``raw.card_movements``: dense id in (source_date, all
    columns) order, ``sourced_from`` always NULL. Rows are numbered per sampled
    range of that order, and offset by the counts before."""
    return conform(ranged_id(landing, MOVEMENT_ORDER), RAW["card_movements"])


def read_raw_source(spark: SparkSession, table: str, lake_root: str, landing_root: str) -> DataFrame:
    if table == "card_movements":
        return raw_movements(scan_landing_csv(spark, landing_root))
    return lake_to_raw(scan_lake(spark, lake_root, table).drop(*PARTITION_COLS), table)


def lake_to_raw(rows: DataFrame, table: str) -> DataFrame:
    """Lake rows typed as the raw table. The raw load carries NULL as the text
    ``None`` in every table, so that text is NULL here too."""
    return rows.select(*_typed(table))


def _typed(table: str) -> list[Column]:
    """The raw table's columns of a lake row."""
    return [(F.nullif(F.col(f.name), F.lit("None")) if isinstance(f.dataType, T.StringType) else F.col(f.name))
            .cast(f.dataType).alias(f.name) for f in RAW[table].fields]


def load_raw(spark: SparkSession, lake_root: str, landing_root: str, raw_root: str,
             tables: Iterable[str] | None = None) -> dict[str, str]:
    """Full refresh of the raw tables (idempotent): a new version of each,
    current once it is complete, so a failed load leaves the old one.

    ``tables`` selects a subset; unknown names are skipped with a warning.
    Returns table -> written path.
    """
    wanted = list(tables) if tables is not None else list(RAW_TABLES)
    out = {}
    for t in wanted:
        if t not in RAW:
            log.warning("skipping unknown raw table %s", t)
            continue
        out[t] = publish(spark, f"{raw_root.rstrip('/')}/{t}", read_raw_source(spark, t, lake_root, landing_root))
    return out


def read_raw(spark: SparkSession, raw_root: str, table: str) -> DataFrame:
    """A raw table (full-refresh or incremental layout); partition columns of
    the incremental layout are not part of the raw schema."""
    current = VersionedTable(spark, f"{raw_root.rstrip('/')}/{table}").read()
    if current is not None:
        return current
    try:
        df = spark.read.schema(RAW[table]).parquet(f"{raw_root.rstrip('/')}/{table}")
        return df.select(*RAW[table].fieldNames())
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return empty(spark, RAW[table])


def sync_raw(spark: SparkSession, lake_root: str, raw_root: str, checkpoint_root: str,
             tables: Iterable[str] = ("transactions", "users", "cards")) -> dict[str, str]:
    """Incremental alternative to :func:`load_raw` for the lake tables.

    The lake is append-only (the ingest sink only adds files; late events go
    to their own date folder), so raw can follow it with a streaming read of
    the sink's file log: each run types and appends only the files added
    since the previous run (``availableNow``, exactly-once via the
    checkpoint), partitioned by the same ``year/month/day``. Raw then holds
    every delivery, as a full refresh would; staging deduplicates.

    Use a raw root of its own for this mode (a folder written by a streaming
    sink is read through that sink's log). Card movements keep the full
    refresh: their dense ids are renumbered from 1 on every load.
    """
    out = {}
    for t in tables:
        if t not in LAKE:
            log.warning("skipping %s: not a lake table", t)
            continue
        try:
            src = spark.readStream.schema(lake_schema(t)).parquet(f"{lake_root.rstrip('/')}/{t}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            log.warning("no lake files for %s under %s yet; skipped", t, lake_root)
            continue
        typed = src.select(*_typed(t), *PARTITION_COLS)
        path = f"{raw_root.rstrip('/')}/{t}"
        q = (typed.writeStream.format("parquet").outputMode("append")
             .partitionBy(*PARTITION_COLS)
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/raw_{t}")
             .trigger(availableNow=True)
             .start(path))
        q.awaitTermination()
        out[t] = path
    return out
