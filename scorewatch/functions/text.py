"""Text cleaning and masking as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scorewatch.functions import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """``nullif(trim(x), '')``: trims spaces only, empty becomes NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def mask_pan(c) -> Column:
    """Keep the last four digits behind a fixed prefix.

    Non-digits are dropped first; fewer than four digits shows all of them;
    a missing PAN shows the prefix alone.
    """
    digits = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[^0-9]", "")
    return F.concat(F.lit(K.PAN_MASK_PREFIX), F.right(digits, F.lit(K.PAN_KEEP_DIGITS)))


def mask_cardholder(c) -> Column:
    """First two characters of the first word, a fixed mask, then the
    initial of the last word and a dot; no words gives ''."""
    words = F.split(F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\s+", " ")), " ")
    first = F.element_at(words, 1)
    last = F.element_at(words, -1)
    return (F.when(first == "", F.lit(""))
            .otherwise(F.concat(F.substring(first, 1, K.CARDHOLDER_KEEP_CHARS),
                                F.lit(K.CARDHOLDER_MASK),
                                F.substring(last, 1, 1), F.lit("."))))
