import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scorewatch.operators.surrogate import dense_id, ranged_id
from scorewatch.sources.landing import scan_landing_csv
from scorewatch.sources.lake import lake_to_raw, load_raw, read_raw, scan_lake
from scorewatch.sources.schemas import LAKE
from scorewatch.streaming.ingest import file_source, select_topics, start_ingest

D = dt.datetime


def _csv(root, day, lines):
    os.makedirs(f"{root}/{day}", exist_ok=True)
    with open(f"{root}/{day}/movimientos.csv", "w") as f:
        f.write("card_id,date,amount,merchant_category,location\n")
        f.write("\n".join(lines) + "\n")


def test_landing_csv(spark, tmp):
    root = f"{tmp}/landing"
    _csv(root, "2024-01-02", ["7,2024-01-02 10:00:00,10.50,None,", "8,2024-01-02 11:00:00,None,food,BA"])
    _csv(root, "2024-01-01", ["9,2024-01-01 09:00:00,1.00,fuel,CBA"])
    with open(f"{root}/2024-01-01/other.csv", "w") as f:
        f.write("a,b\n1,2\n")
    rows = {r.card_id: r for r in scan_landing_csv(spark, root).collect()}
    assert sorted(rows) == [7, 8, 9]
    assert rows[7].merchant_category is None and rows[7].location is None   # 'None' and empty field
    assert rows[8].amount is None and rows[7].amount == Decimal("10.50")
    assert rows[7].source_date == "2024-01-02" and rows[9].source_date == "2024-01-01"
    assert scan_landing_csv(spark, f"{tmp}/missing").count() == 0


def test_dense_id_is_total_and_gapless(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") % 13).alias("d"), (F.col("id") * 7919 % 5000).alias("v"))
    df = df.unionByName(df.limit(10))                        # fully equal rows
    df = df.unionByName(spark.createDataFrame([(None, 3), (4, None), (None, None), (4, None)], "d long, v long"))
    out = dense_id(df, ["d", "v"], F.floor(F.col("v") / 100)).collect()
    ids = sorted(r.id for r in out)
    assert ids == list(range(1, 5015))
    by_id = sorted(out, key=lambda r: r.id)
    keys = [(r.d is None, r.d or 0, r.v is None, r.v or 0) for r in by_id]  # NULLs last
    assert keys == sorted(keys)


def test_ranged_id_splits_a_hot_card(spark):
    """One card with a third of a day's rows: ids are total and gapless, and no
    range holds more than its share."""
    day = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 50 < 40, "2024-01-02").otherwise("2024-01-01").alias("d"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 977).alias("card"), (F.col("id") * 7919 % 60_013).alias("v"))
    day = day.unionByName(spark.createDataFrame([("2024-01-01", None, 5), (None, None, None), ("2024-01-02", 7, None)], day.schema))
    out = ranged_id(day, ["d", "card", "v"])
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(1, 60_004))
    keys = [tuple((x is None, x or (0 if i else "")) for i, x in enumerate(r[1:])) for r in rows]
    assert keys == sorted(keys)
    hot = out.filter("card = 7").groupBy("d", F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert hot < 20_000 / 2  # of 20,000 rows of the card
    assert ranged_id(day.limit(0), ["d", "card", "v"]).count() == 0


def test_dense_id_is_lazy(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    dense_id(spark.range(100).select(F.col("id").alias("d"), F.col("id").alias("v")), ["d", "v"], F.col("v"))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


@pytest.mark.parametrize("line", ["7,2024-01-02 10:00:00,10.50,food,BA,extra", "7,2024-01-02 10:00:00,10.50,food",
                                  "x7,2024-01-02 10:00:00,10.50,food,BA", "7,yesterday,10.50,food,BA"])
def test_landing_line_that_does_not_fit_fails_the_load(spark, tmp, line):
    good = "9,2024-01-01 09:00:00,1.00,fuel,CBA"
    _csv(f"{tmp}/landing", "2024-01-01", [good])
    load_raw(spark, f"{tmp}/lake", f"{tmp}/landing", f"{tmp}/raw", tables=["card_movements"])
    _csv(f"{tmp}/landing", "2024-01-02", [line])
    with pytest.raises(Exception):
        load_raw(spark, f"{tmp}/lake", f"{tmp}/landing", f"{tmp}/raw", tables=["card_movements"])
    # The failed load left the last good version current.
    assert [r.card_id for r in read_raw(spark, f"{tmp}/raw", "card_movements").collect()] == [9]


def test_lake_text_none_is_null(spark):
    lake = spark.createDataFrame([(1, 2, 3.0, "m", "None", True, D(2024, 1, 1)), (2, 2, 3.0, "None", "x", True, D(2024, 1, 1))],
                                 LAKE["transactions"])
    assert [(r.merchant_category, r.location) for r in lake_to_raw(lake, "transactions").orderBy("id").collect()] == [
        ("m", None), (None, "x")]


def _events(path, n, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/batch-{n}.json", "w") as f:
        for topic, key, value in rows:
            f.write(json.dumps({"topic": topic, "key": key, "value": value}) + "\n")


def _tx(i, ts):
    return ("postgres_oltp.public.transactions", str(i), json.dumps(
        {"id": i, "user_id": 1, "amount": "5.00", "merchant_category": "m", "location": "x",
         "is_flagged_fraud": False, "created_at": ts}))


def test_stream_restart_and_partitions(spark, tmp):
    src, lake, ckpt = f"{tmp}/events", f"{tmp}/lake", f"{tmp}/ckpt"
    _events(src, 1, [_tx(1, "2024-01-01T23:59:59Z"), _tx(2, "2024-01-02T00:00:01Z"),
                     ("cards.api", "5", json.dumps({"card_id": 5, "user_id": 1, "pan_last_masked": "**** 1",
                                                    "ingested_at": "2024-01-02T00:00:00Z"})),
                     _tx(3, "junk")])
    for q in start_ingest(file_source(spark, src), lake, ckpt, available_now=True):
        q.awaitTermination()
    _events(src, 2, [_tx(4, "2023-12-31T12:00:00Z")])          # late event
    for q in start_ingest(file_source(spark, src), lake, ckpt, available_now=True):
        q.awaitTermination()
    tx = scan_lake(spark, lake, "transactions")
    got = sorted((r.id, r.year, r.month, r.day) for r in tx.collect())
    assert got == [(1, "2024", "01", "01"), (2, "2024", "01", "02"), (3 + 1, "2023", "12", "31")]
    assert scan_lake(spark, lake, "cards").count() == 1
    assert scan_lake(spark, lake, "users").count() == 0          # topic never seen: empty, same schema
    assert tx.filter("year = '2024' and day = '02'").count() == 1


def test_topic_selection(spark):
    assert [r.table for r in select_topics("cards")] == ["cards"]
    assert len(select_topics()) == 3
    import pytest
    with pytest.raises(ValueError):
        select_topics("nothing")


def test_load_raw_is_idempotent(spark, tmp):
    src, lake, ckpt, raw = f"{tmp}/events", f"{tmp}/lake", f"{tmp}/ckpt", f"{tmp}/raw"
    _events(src, 1, [_tx(1, "2024-01-01T10:00:00Z"), _tx(1, "2024-01-01T10:00:01Z")])
    for q in start_ingest(file_source(spark, src), lake, ckpt, selector="transactions", available_now=True):
        q.awaitTermination()
    _csv(f"{tmp}/landing", "2024-01-01", ["9,2024-01-01 09:00:00,1.00,fuel,CBA"])
    for _ in range(2):
        load_raw(spark, lake, f"{tmp}/landing", raw, tables=["transactions", "card_movements", "bogus"])
    t = read_raw(spark, raw, "transactions")
    assert t.count() == 2 and "year" not in t.columns
    assert dict(t.dtypes)["amount"] == "decimal(15,2)"
    m = read_raw(spark, raw, "card_movements").collect()
    assert [(r.id, r.source_date, r.sourced_from) for r in m] == [(1, "2024-01-01", None)]
    assert read_raw(spark, raw, "users").count() == 0


def test_stream_micro_batches(spark, tmp):
    src, lake, ckpt = f"{tmp}/events", f"{tmp}/lake", f"{tmp}/ckpt"
    for n in range(3):
        _events(src, n, [_tx(10 * n + i, f"2024-01-0{n + 1}T00:00:0{i}Z") for i in range(4)])
    (q,) = start_ingest(file_source(spark, src, max_files_per_trigger=1), lake, ckpt,
                        selector="transactions", available_now=True)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3 and all(p["numInputRows"] == 4 for p in batches)
    tx = scan_lake(spark, lake, "transactions")
    assert tx.count() == 12 and tx.select("id").distinct().count() == 12
    assert sorted(r.day for r in tx.select("day").distinct().collect()) == ["01", "02", "03"]


def test_sync_raw_follows_the_lake(spark, tmp):
    from scorewatch.sources.lake import sync_raw
    src, lake, ckpt, raw_inc, raw_full = (f"{tmp}/{x}" for x in ("ev", "lake", "ckpt", "raw_inc", "raw_full"))
    _events(src, 1, [_tx(1, "2024-01-01T10:00:00Z"), _tx(2, "2024-01-02T10:00:00Z")])
    for q in start_ingest(file_source(spark, src), lake, ckpt, selector="transactions", available_now=True):
        q.awaitTermination()
    sync_raw(spark, lake, raw_inc, ckpt, tables=["transactions"])
    assert read_raw(spark, raw_inc, "transactions").count() == 2
    _events(src, 2, [_tx(3, "2023-12-31T10:00:00Z"), _tx(1, "2024-01-01T10:00:05Z")])   # late + re-delivery
    for q in start_ingest(file_source(spark, src), lake, ckpt, selector="transactions", available_now=True):
        q.awaitTermination()
    sync_raw(spark, lake, raw_inc, ckpt, tables=["transactions"])
    sync_raw(spark, lake, raw_inc, ckpt, tables=["transactions"])        # nothing new: no change
    load_raw(spark, lake, f"{tmp}/landing", raw_full, tables=["transactions"])
    inc = read_raw(spark, raw_inc, "transactions")
    full = read_raw(spark, raw_full, "transactions")
    assert inc.count() == 4 and inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
    assert dict(inc.dtypes)["amount"] == "decimal(15,2)"


def test_sync_raw_skips_missing_lake_tables(spark, tmp):
    from scorewatch.sources.lake import sync_raw
    assert sync_raw(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/ck", ["cards"]) == {}
    assert read_raw(spark, f"{tmp}/raw", "cards").count() == 0
