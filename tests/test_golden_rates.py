"""Rule counts on the derived transactions with batch-1 users equal the
rates recorded for the test tables (FIXTURES.md, section B2)."""

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import scd2
from scorewatch.plans import marts
from scorewatch.plans.catalog import Warehouse

FLAGS = ["alert_high_amount", "alert_limit_exceeded", "alert_velocity", "alert_location_shift",
         "alert_source_flag", "is_fraud_alert"]


@pytest.mark.parametrize("sf,expected,max_cnt", [
    ("0.001", [1000, 71, 49, 12, 98, 50, 235], 6),
    ("0.01", [10000, 806, 574, 128, 989, 504, 2495], 6),
])
def test_rates(spark, sf, expected, max_cnt):
    w = Warehouse(spark, f"/root/testdata/sf{sf}")
    dim = marts.dim_users(scd2.snapshot_initial(w.stg_users_batch(1)))
    a = marts.fct_fraud_alerts(w.stg_transactions, dim)
    row = a.agg(F.count(F.lit(1)), *[F.count_if(f) for f in FLAGS]).first()
    assert list(row) == expected
    assert w.velocity.agg(F.max("cnt_5min")).first()[0] == max_cnt


def test_snapshot_arithmetic(spark):
    snap = Warehouse(spark, "/root/testdata/sf0.01").snapshot(3)
    r = snap.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("dbt_valid_to").isNull()).alias("open")).first()
    assert (r.n, r.open) == (2000, 1470)
    deleted = snap.groupBy("user_id").agg(F.count_if(F.col("dbt_valid_to").isNull()).alias("o")) \
        .filter("o = 0").select("user_id").collect()
    assert sorted(x.user_id for x in deleted) == list(range(7, 1500, 50))
