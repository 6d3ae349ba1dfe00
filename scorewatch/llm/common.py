"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import io
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_col: str | None = None) -> DataFrame:
    """Two columns, ``doc_id`` and ``text`` (and ``block``); a null text is
    empty. Any other column, whatever its name, stays out of the operator."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       *([F.col(block_col).alias("block")] if block_col else []))


def fold(buckets: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % buckets


def ascii_lower(col: Column) -> Column:
    """A-Z only; every other character keeps its form."""
    return F.translate(col, UPPER, UPPER.lower())


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder below the checkpoint folder all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or a path."""
    return fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def sent_to_executors(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a file to the shared folder and have Spark hand it to every
    executor, those that start later too; returns its URI."""
    folder = shared_folder(spark, "files")
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}") as out:
        out.write(content)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return f"{folder}/{name}"


def shipped(query: Callable) -> Callable:
    """The query, after its Python workers can import this package: executors
    may not have it, and a driver may have been started anywhere."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        sc = spark.sparkContext
        if not getattr(sc, "_scorewatch_shipped", False):
            package, raw = Path(__file__).resolve().parents[1], io.BytesIO()
            with zipfile.ZipFile(raw, "w") as out:
                for path in sorted(package.rglob("*.py")):
                    out.write(path, str(path.relative_to(package.parent)))
            sc.addPyFile(sent_to_executors(spark, f"scorewatch-{uuid.uuid4().hex[:12]}.zip", raw.getvalue()))
            sc._scorewatch_shipped = True
        return query(spark, *args)

    return run


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows, written below the shared checkpoint folder and read again:
    computed once, with the lineage cut."""
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text",
           max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece holds about ``max_bytes`` of text
    (or one row): what a task holds doesn't depend on the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and the offsets of its rows; a null is empty."""
    if col.null_count:
        col = pc.fill_null(col, "" if not pa.types.is_binary(col.type) else b"")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]
