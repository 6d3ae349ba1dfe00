"""Data-quality checks over models (DQ1-DQ7).

A check is (model, column, test[, bounds or values]). ``failures`` counts
offending rows, except ``unique``, which counts duplicated values (NULLs are
ignored), as the usual warehouse test does. NULL passes ``between`` and
``accepted_values``.

A model with one ``unique`` column gets all its checks from one scan: a
group-by on that column (map-side partial counts, so a hot duplicate value is
collapsed before the shuffle) that also sums the row-level failures, then a
one-row merge. Otherwise row-level checks share one global aggregate and each
``unique`` check is its own group-by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                       # not_null | unique | between | accepted_values
    min_value: float | None = None
    max_value: float | None = None
    values: tuple = field(default_factory=tuple)


def _failing(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        return c.isNull()
    if check.test == "between":
        bad = F.lit(False)
        if check.min_value is not None:
            bad = bad | (c < F.lit(check.min_value))
        if check.max_value is not None:
            bad = bad | (c > F.lit(check.max_value))
        return c.isNotNull() & bad
    if check.test == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    raise ValueError(f"unknown row-level test {check.test!r}")


def _row(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.model).alias("model"), F.lit(check.column).alias("column_name"),
            F.lit(check.test).alias("test"), failures.cast("bigint").alias("failures")]


def _single_pass(df: DataFrame, uniques: Sequence[Check], row_checks: Sequence[Check]) -> DataFrame:
    """All checks of a frame with one ``unique`` column in one aggregation:
    group by that column (partial counts map-side), then one global merge."""
    key = F.col(uniques[0].column)
    per_key = df.groupBy(key.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(_failing(ch)).alias(f"_f{i}") for i, ch in enumerate(row_checks)])
    agg = per_key.agg(
        F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("_u"),
        *[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(row_checks))])
    rows = [F.struct(*_row(ch, F.col("_u"))) for ch in uniques]
    rows += [F.struct(*_row(ch, F.coalesce(F.col(f"_f{i}"), F.lit(0)))) for i, ch in enumerate(row_checks)]
    return agg.select(F.inline(F.array(*rows)))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, column_name, test, failures. Models that are
    given as the same frame (they differ in columns only) share its pass."""
    parts: list[DataFrame] = []
    by_frame: dict[int, list[Check]] = {}
    for ch in checks:
        by_frame.setdefault(id(models[ch.model]), []).append(ch)
    for group in by_frame.values():
        df = models[group[0].model]
        row_checks = [ch for ch in group if ch.test != "unique"]
        uniques = [ch for ch in group if ch.test == "unique"]
        if len({ch.column for ch in uniques}) == 1:
            parts.append(_single_pass(df, uniques, row_checks))
            continue
        if row_checks:
            agg = df.agg(*[F.count_if(_failing(ch)).alias(f"_f{i}") for i, ch in enumerate(row_checks)])
            pairs = [F.struct(*_row(ch, F.col(f"_f{i}"))) for i, ch in enumerate(row_checks)]
            parts.append(agg.select(F.inline(F.array(*pairs))))
        for ch in uniques:
            dup = (df.filter(F.col(ch.column).isNotNull()).groupBy(ch.column)
                   .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
            parts.append(dup.agg(*_row(ch, F.count(F.lit(1)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join)."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return (child.filter(F.col(child_col).isNotNull())
            .join(keys, F.col(child_col) == F.col("_pk"), "left_anti"))


def relationship_check(model: str, child: DataFrame, parent: DataFrame, child_col: str,
                       parent_col: str) -> DataFrame:
    """Orphan rows, counted per key before the join, so a key that many rows
    share meets its parent once."""
    ch = Check(model, child_col, "relationships")
    keys = child.groupBy(child_col).agg(F.count(F.lit(1)).alias("_n"))
    failures = F.coalesce(F.sum("_n"), F.lit(0))
    return orphans(keys, parent, child_col, parent_col).agg(*_row(ch, failures))


# --- fixed values: the model tests of the warehouse project -------------
MODEL_CHECKS: tuple[Check, ...] = (
    Check("stg_transactions", "transaction_id", "not_null"),
    Check("stg_transactions", "transaction_id", "unique"),
    Check("stg_transactions", "user_id", "not_null"),
    Check("stg_transactions", "created_at", "not_null"),
    Check("stg_users", "user_id", "not_null"),
    Check("stg_users", "user_id", "unique"),
    Check("stg_users", "scoring_crediticio", "not_null"),
    Check("stg_cards", "card_id", "not_null"),
    Check("stg_cards", "card_id", "unique"),
    Check("stg_cards", "user_id", "not_null"),
    Check("stg_card_movements", "source_id", "not_null"),
    Check("stg_card_movements", "source_id", "unique"),
    Check("int_user_transaction_velocity", "transaction_id", "not_null"),
    Check("int_user_transaction_velocity", "transaction_id", "unique"),
    Check("int_user_transaction_velocity", "cnt_5min", "between", min_value=1),
    Check("dim_users", "user_sk", "not_null"),
    Check("dim_users", "user_sk", "unique"),
    Check("dim_users", "scoring_crediticio", "not_null"),
    Check("dim_users", "scoring_crediticio", "between", min_value=300, max_value=850),
    Check("fct_transactions", "transaction_id", "not_null"),
    Check("fct_transactions", "transaction_id", "unique"),
    Check("fct_transactions", "amount_usd", "not_null"),
    Check("fct_transactions", "amount_usd", "between", min_value=0),
    Check("fct_fraud_alerts", "transaction_id", "not_null"),
    Check("fct_fraud_alerts", "transaction_id", "unique"),
    Check("fct_fraud_alerts", "is_fraud_alert", "accepted_values", values=(True, False)),
)
# -------------------------------------------------------------------------


# --- fixed values: constraints of the source tables (DQ6) ----------------
SOURCE_CHECKS: tuple[Check, ...] = (
    Check("raw_users", "id", "not_null"),
    Check("raw_users", "nombre", "not_null"),
    Check("raw_users", "scoring_crediticio", "not_null"),
    Check("raw_users", "scoring_crediticio", "between", min_value=300, max_value=850),
    Check("raw_users", "limite_credito", "not_null"),
    Check("raw_users", "status_riesgo", "not_null"),
    Check("raw_users", "updated_at", "not_null"),
    Check("raw_transactions", "id", "not_null"),
    Check("raw_transactions", "user_id", "not_null"),
    Check("raw_transactions", "amount", "not_null"),
    Check("raw_transactions", "merchant_category", "not_null"),
    Check("raw_transactions", "is_flagged_fraud", "not_null"),
    Check("raw_transactions", "created_at", "not_null"),
)
# -------------------------------------------------------------------------


# --- fixed values: secrets that must never reach the lake ---------------
FORBIDDEN_COLUMNS = ("pan", "cvv")
LONG_DIGIT_RUN = r"[0-9]{5,}"
# -------------------------------------------------------------------------


def pii_findings(df: DataFrame, model: str = "cards") -> DataFrame:
    """No plaintext card data (DQ8): one row per string column with the
    count of values holding five or more consecutive digits, plus one row
    per forbidden column present. All counts come from one aggregate pass."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    checks = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                       F.lit("no_long_digit_run").alias("test"),
                       F.col(f"_p{i}").cast("bigint").alias("failures"))
              for i, c in enumerate(strings)]
    agg = df.agg(*[F.count_if(F.col(c).rlike(LONG_DIGIT_RUN)).alias(f"_p{i}")
                   for i, c in enumerate(strings)])
    present = [c for c in FORBIDDEN_COLUMNS if c in df.columns]
    checks += [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                        F.lit("forbidden_column").alias("test"), F.lit(1).cast("bigint").alias("failures"))
               for c in present]
    return agg.select(F.inline(F.array(*checks)))
