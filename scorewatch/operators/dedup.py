"""Keep one row per key: the earliest or the latest by a timestamp.

``row_number() over (partition by key order by ts) = 1``. Spark plans this as
a partial ``WindowGroupLimit`` before the exchange and a final one after it,
so a key with a huge number of copies is cut to one row per map task before
anything is shuffled.

Ordering follows the warehouse the models were written for: ascending puts
NULL timestamps last, descending puts them first. Ties on the timestamp are
broken by every remaining column (ascending, NULLs last), which makes the
result deterministic; fully equal rows are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def dedup(df: DataFrame, keys: str | Sequence[str], order_col: str, latest: bool,
          tiebreak: Sequence[str] | None = None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    ts = F.col(order_col)
    primary = ts.desc_nulls_first() if latest else ts.asc_nulls_last()
    rest = tiebreak if tiebreak is not None else [
        c for c in df.columns if c not in keys and c != order_col]
    w = Window.partitionBy(*keys).orderBy(primary, *[F.col(c).asc_nulls_last() for c in rest])
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def keep_earliest(df: DataFrame, keys, order_col: str, tiebreak=None) -> DataFrame:
    return dedup(df, keys, order_col, latest=False, tiebreak=tiebreak)


def keep_latest(df: DataFrame, keys, order_col: str, tiebreak=None) -> DataFrame:
    return dedup(df, keys, order_col, latest=True, tiebreak=tiebreak)
