"""Data-quality checks on rows that break them."""

import datetime as dt

from pyspark.sql import functions as F

from scorewatch.operators import quality, rules


def failures(df):
    return {(r.model, r.column_name, r.test): r.failures for r in df.collect()}


def test_every_kind_of_check_counts_bad_rows(spark):
    df = spark.createDataFrame([(1, 300, "a"), (1, 299, "b"), (2, 851, None), (2, None, "x"), (None, 850, "a"), (None, 400, "y")],
                               "id long, score int, band string")
    checks = [quality.Check("m", "id", "not_null"), quality.Check("m", "id", "unique"),
              quality.Check("m", "score", "between", min_value=300, max_value=850),
              quality.Check("m", "band", "accepted_values", values=("a", "b"))]
    want = {("m", "id", "not_null"): 2, ("m", "id", "unique"): 2, ("m", "score", "between"): 2, ("m", "band", "accepted_values"): 2}
    assert failures(quality.run_checks({"m": df}, checks)) == want
    # Without the unique check, the row checks share one aggregate.
    assert failures(quality.run_checks({"m": df}, checks[2:])) == dict(list(want.items())[2:])


def test_relationship_counts_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (8,), (None,)], "user_id long")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "user_id long")
    assert failures(quality.relationship_check("c", child, parent, "user_id", "user_id")) == {("c", "user_id", "relationships"): 3}
    assert failures(quality.relationship_check("c", child.limit(0), parent, "user_id", "user_id")) == {("c", "user_id", "relationships"): 0}


def test_risk_band_check_returns_mismatches(spark):
    users = spark.createDataFrame([(1, 720, "bajo"), (2, 720, "alto"), (3, None, None), (4, None, "alto"), (5, 549, None)],
                                  "user_id long, scoring_crediticio int, status_riesgo string").withColumn(
        "valid_from", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    assert sorted((r.user_id, r.expected_status) for r in rules.risk_band_check(users).collect()) == [(2, "bajo"), (4, None), (5, "alto")]
