import datetime as dt
from decimal import Decimal



from scorewatch.operators import rules
from scorewatch.operators.dedup import keep_earliest, keep_latest
from scorewatch.plans import serving

T0 = dt.datetime(2024, 1, 1)


def test_dedup_null_ordering(spark):
    s = "k long, ts timestamp_ntz, v string"
    df = spark.createDataFrame([(1, None, "null"), (1, T0, "t0"), (1, T0 + dt.timedelta(1), "t1"),
                                (2, None, "only-null")], s)
    early = {r.k: r.v for r in keep_earliest(df, "k", "ts").collect()}
    late = {r.k: r.v for r in keep_latest(df, "k", "ts").collect()}
    assert early == {1: "t0", 2: "only-null"}      # ascending: NULLs last
    assert late == {1: "null", 2: "only-null"}      # descending: NULLs first


def test_dedup_full_ties_are_deterministic(spark):
    s = "k long, ts timestamp_ntz, v string"
    df = spark.createDataFrame([(1, T0, "b"), (1, T0, "a"), (1, T0, "a")], s)
    assert [r.v for r in keep_earliest(df, "k", "ts").collect()] == ["a"]
    assert [r.v for r in keep_latest(df, "k", "ts").collect()] == ["a"]


def test_dedup_pre_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, T0, "a")], "k long, ts timestamp_ntz, v string")
    plan = keep_latest(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


ALERT_IN = ("transaction_id long, amount_usd decimal(15,2), limite_credito decimal(15,2), cnt_5min long, "
            "location string, user_location string, is_flagged_fraud boolean")


def test_rule_edges(spark):
    rows = [
        (1, Decimal("4999.99"), None, 1, "A", "A", False),
        (2, Decimal("5000.00"), None, 1, "A", "A", False),
        (3, Decimal("100.00"), Decimal("100.00"), 4, None, "A", None),     # equal to limit: no alert
        (4, Decimal("100.01"), Decimal("100.00"), 5, "A", None, False),    # no user location
        (5, None, None, None, "B", "A", True),                             # no current user values
    ]
    out = {r.transaction_id: r for r in rules.evaluate(spark.createDataFrame(rows, ALERT_IN)).collect()}
    assert not out[1].alert_high_amount and out[2].alert_high_amount
    assert not out[3].alert_limit_exceeded and out[4].alert_limit_exceeded
    assert not out[3].alert_velocity and out[4].alert_velocity
    assert not out[4].alert_location_shift and out[5].alert_location_shift
    assert not out[3].alert_source_flag and out[5].alert_source_flag
    assert not out[1].is_fraud_alert and all(out[i].is_fraud_alert for i in (2, 4, 5))
    assert not out[3].is_fraud_alert


def test_width_bucket_edges(spark):
    dim = spark.createDataFrame(
        [(i, s, "x", True) for i, s in enumerate([299, 300, 349, 350, 849, 850])],
        "user_id long, scoring_crediticio int, status_riesgo string, is_current boolean")
    got = {(r.min_score, r.bucket) for r in serving.score_distribution(dim).collect()}
    assert got == {(299, 0), (300, 1), (350, 2), (849, 11), (850, 12)}


def test_rates_keep_zero_groups_and_rules(spark):
    s = ("transaction_id long, created_at timestamp_ntz, is_fraud_alert boolean, alert_high_amount boolean, "
         "alert_limit_exceeded boolean, alert_velocity boolean, alert_location_shift boolean, "
         "alert_source_flag boolean")
    a = spark.createDataFrame([
        (1, T0, False, False, False, False, False, False),
        (2, T0 + dt.timedelta(hours=1), True, True, False, False, False, False)], s)
    hours = {r.hora: (r.tx_total, r.tx_con_alertas, r.pct_fraude)
             for r in serving.fraud_pct_by_hour(a).collect()}
    assert hours[T0] == (1, 0, 0.0) and hours[T0 + dt.timedelta(hours=1)] == (1, 1, 100.0)
    by_rule = {r.regla: r.alertas for r in serving.alerts_by_rule(a).collect()}
    assert len(by_rule) == 5 and by_rule["monto-alto"] == 1 and by_rule["flag-oltp"] == 0


def test_dedup_matches_python_on_random_rows(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 30), rnd.choice([None, T0, T0 + dt.timedelta(1), T0 + dt.timedelta(2)]),
             rnd.choice([None, "a", "b", "c"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v string")

    def pick(group, latest):
        # ts: ascending puts NULL last, descending puts NULL first; then v ascending, NULL last.
        def key(r):
            ts_key = (r[1] is None, r[1] or T0) if not latest else (r[1] is not None, -(r[1] - T0).total_seconds() if r[1] else 0)
            return (ts_key, r[2] is None, r[2] or "")
        return min(group, key=key)

    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    for latest, fn in ((False, keep_earliest), (True, keep_latest)):
        want = sorted(pick(g, latest) for g in groups.values())
        got = sorted(tuple(r) for r in fn(df, "k", "ts").collect())
        assert got == want


def test_alert_velocity_needs_a_transaction_id(spark):
    from scorewatch.plans import marts
    tx = spark.createDataFrame(
        [(i if i < 5 else None, 1, T0 + dt.timedelta(seconds=i), Decimal("1.00"), "m", "A", False) for i in range(6)],
        "transaction_id long, user_id long, created_at timestamp_ntz, amount_usd decimal(15,2), "
        "merchant_category string, location string, is_flagged_fraud boolean")
    dim = spark.createDataFrame([(1, "sk", Decimal("100.00"), "A", True)],
                                "user_id long, user_sk string, limite_credito decimal(15,2), location string, "
                                "is_current boolean")
    got = {r.transaction_id: r.alert_velocity for r in marts.fct_fraud_alerts(tx, dim).collect()}
    assert got[4] is True                 # fifth transaction within five minutes
    assert got[None] is False             # a NULL id finds no velocity row
