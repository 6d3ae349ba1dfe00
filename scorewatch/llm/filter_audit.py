"""Filter interaction audit: what each filter removes, in every order.

A document's row of the failure mask has one bit per filter. Documents of one
part (of a language, say) with the same mask are one cell, with the number of
its documents and of the marked ones among them; there are 2^f cells a part at
most, however large the table. All orders of the filters pass through the same
2^f subsets, so

1. the subsets are walked in Gray-code order: each step switches one filter on
   or off. Every cell keeps the number of active filters it fails; where that
   number leaves or reaches zero, the cell's documents leave or join the
   running survivors. The 2^f states are stored;
2. a step of an order goes from one subset to the next larger one; what the
   filter removes there is the difference of two stored states.

Copies: a document fails the copy filter if a document of smaller id has the
same text (equal SHA-256), anywhere in the table, removed or not. Copies are
counted, not joined: rows are added up per text and part before they meet, and
of the copies with the smallest id none fails.

Defined cases: null texts are empty; a null part is an empty one; null ids are
neither smaller nor larger than any, so such rows neither are copies nor make
any; repeated rows count each, and a document whose id has several label rows
is marked if one of them marks it; no row, no part; very long texts are scanned
once; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> tuple[Column, Column]:
    """Number of words and of distinct words; words are runs of characters
    other than space and 0x09 to 0x0D."""
    bare = F.btrim(text, F.lit(BLANK))
    words = F.split(bare, r"[ \x09-\x0D]+", -1)
    return (F.when(bare == "", 0).otherwise(F.size(words)), F.when(bare == "", 0).otherwise(F.size(F.array_distinct(words))))


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on one text."""
    words, distinct = n_words(text)
    return {
        "A": words < 200,
        "B": 100 * distinct < 50 * words,
        "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 3 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def cells(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], marks: Mapping[str, Column],
          part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", copies: bool = True) -> DataFrame:
    """part, mask, n, and one count per mark. ``filters`` are conditions on the
    column ``text`` in bit order; the copy filter, if wanted, has the bit after
    them. ``marks`` are conditions on columns of ``labels`` (joined by id)."""
    text = F.col("text")
    # No condition is null, and each text is looked at once, before any exchange.
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    mask = sum((F.when(fails, 1 << bit).otherwise(0) for bit, fails in enumerate(filters.values())), F.lit(0))
    digest = F.unhex(F.sha2(text, 256)) if copies else F.lit(None).cast("binary")
    narrow = rows.select("id", "part", mask.alias("mask"), digest.alias("digest"))
    # Repeated rows are added up on the map side, so that one id is one row.
    narrow = narrow.groupBy("id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marked = (labels.select(F.col(id_col).alias("id"), *[m.cast("int").alias(f"_{k}") for k, m in marks.items()])
              .filter("id IS NOT NULL").groupBy("id").agg(*[F.max(f"_{k}").alias(f"_{k}") for k in marks]))
    flags = [f"_{k}" for k in marks]
    rows = narrow.join(marked, "id", "left").select(
        "id", "part", "mask", "digest", "n", *[F.coalesce(c, F.lit(0)).alias(c) for c in flags])
    if copies:
        rows = _with_copies(rows, flags, 1 << len(filters))
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(f"_{k}")).alias(k) for k in marks])


def _with_copies(rows: DataFrame, flags: list[str], bit: int) -> DataFrame:
    """part, mask with the copy filter's bit, n, flags: rows of equal text,
    part and flags are one row (two if only some of them fail)."""
    per_text = rows.groupBy("digest", "part", "mask", *flags).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("low"))
    # As many rows per text as it has parts and flags, so a group is small here.
    first = per_text.groupBy("digest").agg(F.min("low.id").alias("first"))
    joined = per_text.join(first, "digest")
    stays = F.col("nameless") + F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0)
    each = F.array(F.struct(F.col("mask").alias("mask"), stays.alias("n")),
                   F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - stays).alias("n")))
    return joined.select("part", *flags, F.explode(each).alias("c")).select("part", *flags, "c.mask", "c.n").filter("n > 0")


def survivors(counts: np.ndarray) -> np.ndarray:
    """State of every subset of filters, by Gray code. ``counts`` has a row per
    mask; so has the result: what is left when the filters of that subset run."""
    states = np.zeros_like(counts)
    masks = np.arange(len(counts))
    failures = np.zeros(len(counts), np.int64)  # active filters that a cell fails
    running, subset = counts.sum(0), 0
    states[0] = running
    for step in range(1, len(counts)):
        bit = step & -step
        subset ^= bit
        hit = (masks & bit) > 0
        if subset & bit:
            running = running - counts[hit & (failures == 0)].sum(0)
            failures[hit] += 1
        else:
            failures[hit] -= 1
            running = running + counts[hit & (failures == 0)].sum(0)
        states[subset] = running
    return states


def steps(counts: np.ndarray, names: str) -> list[tuple]:
    """One row per order and step from one part's cells (columns: documents,
    then the marks): filter_order, step, kept, removed, redundant,
    unique_fails, what is lost of each mark, shapley."""
    states = survivors(counts)
    bits = {name: 1 << x for x, name in enumerate(names)}
    masks = np.arange(len(counts))
    fails = {name: int(counts[(masks & bit) > 0, 0].sum()) for name, bit in bits.items()}
    out, shapley = [], dict.fromkeys(names, 0)
    for order in permutations(names):
        subset = 0
        for step, name in enumerate(order, 1):
            before, subset = states[subset], subset | bits[name]
            removed = (before - states[subset]).tolist()
            shapley[name] += removed[0]
            out.append(("".join(order), step, int(states[subset][0]), removed[0], fails[name] - removed[0],
                        int(counts[bits[name], 0]), *removed[1:]))
    return [(*row, shapley[row[0][row[1] - 1]]) for row in out]


def audit(cells: DataFrame, names: str, lost: Mapping[str, str]) -> DataFrame:
    """The steps of every order of the filters ``names`` (a letter each, in bit
    order), for each part. ``lost`` names the result column of each mark."""
    marks = list(lost)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *lost.values(), "shapley"]
    kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * (len(columns) - 3)

    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros((1 << len(names), 1 + len(marks)), np.int64)
        mask = table.column("mask").to_numpy()
        for x, name in enumerate(["n", *marks]):
            np.add.at(counts[:, x], mask, table.column(name).to_numpy())
        rows = steps(counts, names)
        part = table.column("part")[0].as_py()
        return pa.table([pa.array([part] * len(rows), pa.string()),
                         *[pa.array(list(x), kind) for x, kind in zip(zip(*rows), kinds[1:])]], columns)

    schema = ", ".join(f"{c} {'string' if x < 2 else 'int' if x == 2 else 'long'}" for x, c in enumerate(columns))
    return cells.groupBy("part").applyInArrow(run, schema)
