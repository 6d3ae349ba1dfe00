"""Tables whose partitions are replaced one by one.

A write holds only the partitions that changed, in a folder of its own
(``w=<n>/<part>=<value>``); the others keep their files. Which folder holds a
partition is a small published table, one row per partition, so a write shows as
a whole or not at all, and a failed one is written again under the same number.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewatch.sources.versioned import VersionedTable

NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_POINTER = "part string, folder string, table_schema string, note string"


class PartitionedTable:
    """``parts``: the partition columns, dates, numbers or plain words. A
    partition is named by its value, of several columns joined by ``/``."""

    def __init__(self, spark: SparkSession, root: str, *parts: str):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), parts
        self.pointer = VersionedTable(spark, f"{self.root}/_parts")

    def version(self) -> int:
        return self.pointer.current_version() or 0

    def _state(self) -> tuple[dict[str, str], str | None, str | None]:
        """Folder of each partition, schema and note of the last write."""
        held = self.pointer.read()
        if held is None:
            return {}, None, None
        rows = held.collect()  # one per partition
        head = next(r for r in rows if r.part is None)
        return {r.part: r.folder for r in rows if r.part is not None}, head.table_schema, head.note

    def folders(self) -> dict[str, str]:
        return self._state()[0]

    def note(self) -> str | None:
        return self._state()[2]

    def read(self, only: Iterable[str] | None = None) -> DataFrame | None:
        """The table, or its partitions ``only`` (as text); None before the
        first write. Predicates on the partition column prune further."""
        folders, schema, _ = self._state()
        if schema is None:
            return None
        wanted = None if only is None else set(only)
        paths = [f for p, f in folders.items() if wanted is None or p in wanted]
        as_written = T.StructType.fromJson(json.loads(schema))
        if not paths:
            return self.spark.createDataFrame([], as_written)
        df = self.spark.read.schema(as_written).option("basePath", self.root).parquet(*paths)
        return df.select(*as_written.fieldNames())

    def replace(self, df: DataFrame, touched: Iterable[str] = (), layout: Callable[[DataFrame], DataFrame] | None = None,
                note: str | None = None, options: dict[str, str] | None = None) -> int:
        """Write the partitions that ``df`` holds; those of ``touched`` that it
        doesn't hold are gone. Returns the version."""
        folders, _, _ = self._state()
        n = self.version() + 1
        folder = f"{self.root}/w={n}"
        (layout(df) if layout else df).write.mode("overwrite").options(**(options or {})).partitionBy(*self.parts).parquet(folder)
        written = (self.spark.read.schema(df.schema).parquet(folder)
                   .select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART)).alias(c) for c in self.parts]).distinct().collect())
        now = {p: f for p, f in folders.items() if p not in set(touched)}
        for row in written:
            now["/".join(row)] = "/".join([folder, *[f"{c}={v}" for c, v in zip(self.parts, row)]])
        rows = [(None, None, df.schema.json(), note), *[(p, f, None, None) for p, f in sorted(now.items())]]
        self.pointer.commit(self.spark.createDataFrame(rows, _POINTER).coalesce(1))
        return n


def part_text(values: Iterable) -> list[str]:
    """Partition values as ``PartitionedTable`` names them."""
    return [NULL_PART if v is None else str(v) for v in values]
