"""End to end on sf0.001: events -> stream -> lake -> raw -> models -> report."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from scorewatch.functions.timecols import ntz
from scorewatch.operators import scd2
from scorewatch.plans import marts, staging
from scorewatch.plans.pipeline import SnapshotStore, build_all
from scorewatch.sources import testdata as td
from scorewatch.sources.lake import load_raw
from scorewatch.streaming import cards, decode
from scorewatch.streaming.ingest import file_source, start_ingest

from conftest import SF_SMALL


def _publish(df, topic, path):
    df.select(F.lit(topic).alias("topic"), "key", "value").write.mode("append").json(path)


def _landing(spark, sf, root, days):
    rows = (td.card_movements_landing(spark, sf).filter(F.col("source_date").isin(days)).collect())
    for day in days:
        os.makedirs(f"{root}/{day}", exist_ok=True)
        with open(f"{root}/{day}/movimientos.csv", "w") as f:
            f.write("card_id,date,amount,merchant_category,location\n")
            for r in rows:
                if r.source_date == day:
                    f.write(f"{r.card_id},{r.date:%Y-%m-%d %H:%M:%S},{r.amount:.2f},{r.merchant_category},{r.location}\n")
    return len(rows)


def test_build_all_from_events(spark, tmp):
    ev, lake, ckpt, raw, out, landing = (f"{tmp}/{x}" for x in ("ev", "lake", "ckpt", "raw", "out", "landing"))
    _publish(decode.encode_transactions(td.transactions_lake(spark, SF_SMALL)),
             "postgres_oltp.public.transactions", ev)
    _publish(decode.encode_users(td.users_lake(spark, SF_SMALL, 1)), "postgres_oltp.public.users", ev)
    feed = td.card_feed(spark, SF_SMALL).filter(F.col("ingested_at") == ntz(td.CARD_INGESTED[0]))
    pages = td.card_pages(feed, 50)
    cards.publish_card_events(cards.card_events(pages, ntz("2024-01-01 00:00:00")), path=ev)
    n_mov = _landing(spark, SF_SMALL, landing, ["1995-01-02", "1996-03-10", "1998-07-01"])

    for q in start_ingest(file_source(spark, ev), lake, ckpt, available_now=True):
        q.awaitTermination()
    load_raw(spark, lake, landing, raw)
    paths = build_all(spark, raw, out, ntz("2024-01-01 01:00:00"))

    # Same alerts as the in-memory plan over the derived raw tables.
    stg_tx = staging.stg_transactions(td.transactions_raw(spark, SF_SMALL))
    dim = marts.dim_users(scd2.snapshot_initial(staging.stg_users(td.users_raw(spark, SF_SMALL, 1))))
    want = marts.fct_fraud_alerts(stg_tx, dim)
    mart = spark.read.parquet(paths["fct_fraud_alerts"])
    got = mart.drop("event_date")
    assert got.count() == want.count() == 1000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    from scorewatch.plans import serving
    summary = serving.fraud_summary(mart, ntz("2024-01-01 06:00:00"), 3)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert summary.count() == 3

    report = {(r.model, r.column_name, r.test): r.failures
              for r in spark.read.parquet(paths["dq_report"]).collect()}
    assert len(report) == 26 and all(v == 0 for v in report.values()), report
    assert spark.read.parquet(f"{raw}/card_movements").count() == n_mov
    assert spark.read.parquet(f"{raw}/cards").count() == 150
    assert not {"pan", "cvv"} & set(spark.read.parquet(f"{lake}/cards").columns)
    assert spark.read.parquet(f"{lake}/cards").filter(F.col("pan_last_masked").rlike("[0-9]{5,}")).count() == 0

    # Second batch: users change; the snapshot gains a version, nothing is overwritten.
    _publish(decode.encode_users(td.users_lake(spark, SF_SMALL, 2)), "postgres_oltp.public.users", ev)
    for q in start_ingest(file_source(spark, ev), lake, ckpt, selector="users", available_now=True):
        q.awaitTermination()
    load_raw(spark, lake, landing, raw, tables=["users"])
    build_all(spark, raw, out, ntz("2024-01-01 03:30:00"))
    store = SnapshotStore(spark, f"{out}/snapshots/snap_users_scoring")
    assert store.current_version() == 2
    assert store.read(1).count() == 150
    snap = store.read()
    assert snap.count() == 150 + 50 and snap.filter(F.col("dbt_valid_to").isNull()).count() == 150


    # SQL over the published tables gives what the serving functions give.
    from scorewatch.plans.pipeline import read_published, register_tables
    from scorewatch.plans import serving as sv
    located = register_tables(spark, out, "wh")
    assert located["dim_users"].endswith("/v=2")          # the latest committed build
    hourly = spark.sql("""
        SELECT CAST(date_trunc('hour', created_at) AS TIMESTAMP_NTZ) AS hora, count(*) AS tx_total,
               count(*) FILTER (WHERE is_fraud_alert) AS tx_con_alertas
        FROM wh.fct_fraud_alerts GROUP BY 1""")
    want_h = sv.fraud_pct_by_hour(read_published(spark, f"{out}/marts/fct_fraud_alerts")).drop("pct_fraude")
    assert hourly.exceptAll(want_h).count() == 0 and want_h.exceptAll(hourly).count() == 0
    hist = spark.sql("""
        SELECT status_riesgo, width_bucket(scoring_crediticio, 300, 850, 11) AS bucket,
               min(scoring_crediticio) AS min_score, max(scoring_crediticio) AS max_score, count(*) AS usuarios
        FROM wh.dim_users WHERE is_current GROUP BY 1, 2""")
    want_d = sv.score_distribution(read_published(spark, f"{out}/marts/dim_users"))
    assert hist.exceptAll(want_d).count() == 0 and want_d.exceptAll(hist).count() == 0

    # Command line over the same output.
    from scorewatch.__main__ import main
    import contextlib, io, json as _json
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(["serve", "alerts", "--out", out, "--limit", "5"])
        main(["serve", "alerts-by-rule", "--out", out])
        main(["serve", "credit-score", "--out", out, "--user", "3"])
        main(["report", "--out", out])
        missing = main(["serve", "credit-score", "--out", out, "--user", "999999"])
    lines = [_json.loads(x) for x in buf.getvalue().splitlines()]
    assert missing == 1
    assert len(lines) == 5 + 5 + 2 + 26
    assert [x["user_id"] for x in lines[10:12]] == [3, 3]


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "transaction_id" and df.count() == 1000
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


def test_build_before_any_data(spark, tmp):
    from scorewatch.plans.pipeline import read_published, register_tables
    build_all(spark, f"{tmp}/raw", f"{tmp}/out", ntz("2024-01-01 00:00:00"))
    assert read_published(spark, f"{tmp}/out/marts/fct_fraud_alerts").count() == 0
    report = read_published(spark, f"{tmp}/out/reports/dq_report")
    assert report.count() == 26 and report.filter("failures > 0").count() == 0
    register_tables(spark, f"{tmp}/out", "empty_wh")
    assert spark.sql("SELECT count(*) AS n FROM empty_wh.fct_fraud_alerts").first().n == 0
