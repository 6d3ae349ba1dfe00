"""Timestamp helpers that do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS_PER_MINUTE = 60_000_000


def epoch_micros(c: Column) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c)


def ntz(literal: str) -> Column:
    """A ``timestamp_ntz`` literal from ``'YYYY-MM-DD HH:MM:SS'`` text."""
    return F.lit(literal).cast("timestamp_ntz")


def trunc_ntz(unit: str, c: Column) -> Column:
    """``date_trunc`` that keeps the ``timestamp_ntz`` type."""
    return F.date_trunc(unit, c).cast("timestamp_ntz")
