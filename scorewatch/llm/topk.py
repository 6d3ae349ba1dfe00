"""Exact top-k inner-product search over integer vectors by columnar
branch-and-bound.

Candidates are held in vertical layout, one array per dimension. A query adds
up its scores dimension block by dimension block; after each block the mass
that is left (product of the norms of what remains of both vectors) bounds
every candidate's final score, the k-th best lower bound is the bar, and
candidates whose upper bound lies under it are compacted away. Scores are
64-bit integers, and a candidate whose bound equals the bar stays, so the result is
exact, ties included.

The stated query set goes over all rows in blocks: the queries are written once
to the shared folder, and every task reads them block by block for each stretch
of candidates of at most ``stretch_bytes``. So a task holds one block of at most
``block`` queries and one stretch, whatever the tables' sizes; nothing of the
queries passes through the driver or is broadcast, and the plan is the same for
any number of them. A stretch hands on k rows per query at most.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part, nor do rows with a null id; vectors are compared with those of
the same number of dimensions; rows that share an id with the query are its
own; a query id that occurs more than once is searched with its smallest
vector, while every repeated row is a candidate; an empty table gives no rows.
Components times ``scale`` must fit into 31 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, store

DIMENSIONS = 16  # a block of dimensions


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * component), of the rows that take part."""
    inf = float("inf")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(inf))

    vec = F.col(vec_col).cast("array<double>")
    return (df.filter(F.col(id_col).isNotNull() & vec.isNotNull() & F.forall(vec, finite))
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(vec, lambda x: F.floor(x * F.lit(float(scale))).cast("long")).alias("v")))


def _vertical(vectors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and the dimensions-by-rows array, for each number of dimensions."""
    for batch in vectors.combine_chunks().to_batches():
        col = batch.column("v")
        ids = batch.column("vec_id").to_numpy()
        starts = col.offsets.to_numpy()
        sizes, flat = np.diff(starts), col.values.to_numpy(zero_copy_only=False)
        for d in np.unique(sizes):
            rows = np.flatnonzero(sizes == d)
            yield ids[rows], np.ascontiguousarray(flat[starts[rows][:, None] + np.arange(d)].T)


def _stretches(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Batches put together until they have ``max_bytes``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= max_bytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _blocks(folder: str, block: int) -> Iterator[pa.Table]:
    """The written queries, ``block`` at most at a time."""
    files, root = store(folder)
    for info in sorted(files.get_file_info(fs.FileSelector(root)), key=lambda f: f.path):
        if info.base_name.endswith(".parquet"):
            with files.open_input_file(info.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(block):
                    yield pa.Table.from_batches([batch])


def _remaining(x: np.ndarray) -> np.ndarray:
    """Norm of what is left of each column from each block on, rounded up."""
    square = np.add.reduceat(x.astype(np.float64) ** 2, np.arange(0, len(x), DIMENSIONS), axis=0)
    return np.sqrt(np.cumsum(square[::-1], axis=0)[::-1]) * (1 + 1e-9)


def search(ids: np.ndarray, x: np.ndarray, rest: np.ndarray, query: np.ndarray, query_rest: np.ndarray,
           own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the candidates that may be among the k best."""
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive), np.int64)
    for b, start in enumerate(range(0, len(x), DIMENSIONS)):
        block = x[start: start + DIMENSIONS]
        score += query[start: start + DIMENSIONS] @ (block if len(alive) == len(ids) else block[:, alive])
        slack = np.zeros(len(alive))
        if b + 1 < len(rest):
            slack = np.ceil(rest[b + 1, alive] * query_rest[b + 1]) + 1
        low = score - slack
        bar = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else -np.inf
        keep = score + slack >= bar
        if not keep.all():
            alive, score = alive[keep], score[keep]
        if not len(alive):
            break
    return ids[alive], score


def top_k(df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vec_col: str = "embedding", block: int = 8192, stretch_bytes: int = 64 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of each query, ties
    to the smaller vec_id."""
    folder = shared_folder(df.sparkSession, "queries")
    asked = quantised(df.filter(is_query), id_col, vec_col, scale)
    asked.groupBy("vec_id").agg(F.min("v").alias("v")).write.parquet(folder)
    found = _over_all(quantised(df, id_col, vec_col, scale), folder, k, block, stretch_bytes)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _over_all(vectors: DataFrame, folder: str, k: int, block: int, stretch_bytes: int) -> DataFrame:
    def run(batches):
        for stretch in _stretches(batches, stretch_bytes):
            held = {len(x): (ids, x, _remaining(x) if len(x) else np.zeros((0, len(ids)))) for ids, x in _vertical(stretch)}
            for queries in _blocks(folder, block):
                out = []
                for asked, every in _vertical(queries):
                    if len(every) not in held:
                        continue
                    ids, x, rest = held[len(every)]
                    every_rest = _remaining(every) if len(every) else every
                    for own, q, q_rest in zip(asked, np.ascontiguousarray(every.T), every_rest.T):
                        new, score = search(ids, x, rest, q, q_rest, own, k)
                        order = np.lexsort((new, -score))[:k]
                        out.append((np.full(len(order), own), new[order], score[order]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)],
                                                     ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")
