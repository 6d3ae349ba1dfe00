"""Dense surrogate ids 1..n in a total order, without a single-partition sort.

A global ``row_number()`` without ``PARTITION BY`` moves every row to one task.
Instead the order's first column and a range of its second column name groups
that follow each other in the order. Rows are numbered inside their group, and
a group's offset is the number of rows in all groups before it:

* counts per (first column, range) come from a partial aggregation;
* their running sum within one value of the first column, and the running sum
  of the totals over the first column's values, are windows over these counts
  only, never over rows.

Rows are shuffled once, by group; a value of the first column that holds much
of the data is spread over its ranges. Nothing runs before an action.

``ranged_id`` needs no ranges to be named: Spark samples the whole order and
cuts it where the rows are, so that one date, or one card of one date, with a
third of all rows is split by the columns after it. The input is written to the
checkpoint folder first, so that it is derived once; the rows sorted inside their
range are written there with their place, so that the places are the same when a
task is run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewatch.session import ensure_checkpoint_dir


def dense_id(df: DataFrame, order: Sequence[str], part: Column, id_col: str = "id") -> DataFrame:
    """``order``: the columns of the total order, NULLs last; ``part``: a
    non-decreasing function of its second column (NULL only where that is)."""
    first = F.col(order[0])
    rows = df.withColumn("_part", part)
    counts = rows.groupBy(first.alias("_first"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    days = counts.groupBy("_first").agg(F.sum("_n").alias("_total"))
    # One row per value of the first column: days of the landing folders.
    before = Window.orderBy(F.col("_first").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("_first").alias("_day"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy("_first").orderBy(F.col("_p").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (counts.withColumn("_inner", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
               .join(days, F.col("_first").eqNullSafe(F.col("_day")))
               .select("_first", "_p", (F.col("_base") + F.col("_inner")).alias("_offset")))
    along = Window.partitionBy(order[0], "_part").orderBy(*[F.col(c).asc_nulls_last() for c in order[1:]])
    numbered = rows.withColumn("_rn", F.row_number().over(along))
    joined = numbered.join(offsets, first.eqNullSafe(F.col("_first")) & F.col("_part").eqNullSafe(F.col("_p")))
    return joined.select((F.col("_offset") + F.col("_rn")).alias(id_col), *df.columns)


def ranged_id(df: DataFrame, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """``order``: the columns of the total order, NULLs last. Rows equal in all
    of them take their numbers in any order. Runs one job at once."""
    ensure_checkpoint_dir(df.sparkSession)
    along = [F.col(c).asc_nulls_last() for c in order]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The id's upper bits number the ranges, in order; the lower 33 the rows inside.
    placed = (df.checkpoint().repartitionByRange(ranges, *along).sortWithinPartitions(*along)
              .withColumn("_at", F.monotonically_increasing_id()).checkpoint())
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_first")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (placed.join(F.broadcast(offsets), part == F.col("_first"))
            .select((F.col("_offset") + inside + 1).alias(id_col), *df.columns))
