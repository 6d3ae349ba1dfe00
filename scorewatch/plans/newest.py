"""Newest alerts first from date partitions (Q3, Q8).

The newest partitions are looked at first, twice as many each time, until they
hold enough alerts; older ones are never opened. A date's alerts are all newer
than those of the dates before it, so the result is the same as over the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from scorewatch.functions import constants as K
from scorewatch.plans import serving
from scorewatch.sources.partitioned import NULL_PART, PartitionedTable


def newest_partitions(table: PartitionedTable, wanted: Callable[[DataFrame], DataFrame], limit: int) -> list[str]:
    """The newest partitions that hold ``limit`` of the ``wanted`` rows together
    (all, if the table doesn't). Rows without a time come before all dates."""
    dates = sorted(table.folders(), reverse=True)
    dates.sort(key=lambda p: p != NULL_PART)
    taken, found, step = 0, 0, 1
    while taken < len(dates) and found < limit:
        chunk = dates[taken: taken + step]
        found += wanted(table.read(chunk)).limit(limit - found).count()
        taken, step = taken + len(chunk), step * 2
    return dates[:taken]


def _newest(table: PartitionedTable, wanted: Callable[[DataFrame], DataFrame], limit: int) -> DataFrame:
    return table.read(newest_partitions(table, wanted, limit))


def active_alerts(table: PartitionedTable, limit: int = K.ALERTS_LIMIT_DEFAULT, user_id: int | None = None) -> DataFrame:
    """As ``serving.active_alerts``, from the partitions that matter (Q3)."""

    def wanted(df: DataFrame) -> DataFrame:
        df = df.filter(F.col("is_fraud_alert"))
        return df if user_id is None else df.filter(F.col("user_id") == F.lit(user_id))

    return serving.active_alerts(_newest(table, wanted, limit), limit, user_id)


def alert_feed(table: PartitionedTable, limit: int = K.FEED_LIMIT) -> DataFrame:
    """As ``serving.alert_feed``, from the partitions that matter (Q8)."""
    return serving.alert_feed(_newest(table, lambda df: df.filter(F.col("is_fraud_alert")), limit), limit)
