"""One read for all tables, restarts, compaction, publishing a batch twice."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from scorewatch.sources import lake_batches as lb
from scorewatch.sources.lake import load_raw, read_raw, scan_lake
from scorewatch.streaming import cards, ingest

TX, US = "postgres_oltp.public.transactions", "postgres_oltp.public.users"


def event(topic, i, day):
    at = f"2024-01-{day:02d}T00:00:{i % 60:02d}Z"
    if topic == TX:
        return {"id": i, "user_id": i % 3, "amount": "5.00", "merchant_category": "m", "location": "A", "is_flagged_fraud": False, "created_at": at}
    return {"id": i, "nombre": "n", "scoring_crediticio": 500, "limite_credito": "10.00", "status_riesgo": "alto", "location": "A", "updated_at": at}


def put(path, n, events):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/f{n}.json", "w") as f:
        for topic, value in events:
            f.write(json.dumps({"topic": topic, "key": "k", "value": json.dumps(value)}) + "\n")


def run(spark, tmp, **kw):
    q = ingest.start_fanout(ingest.file_source(spark, f"{tmp}/ev", max_files_per_trigger=1), f"{tmp}/lake", f"{tmp}/ck", available_now=True, **kw)
    q.awaitTermination()
    return q


def ids(df):
    return sorted(r.id for r in df.collect())


def test_one_read_per_batch_and_restart(spark, tmp, monkeypatch):
    put(f"{tmp}/ev", 0, [(TX, event(TX, i, 1 + i % 2)) for i in range(20)] + [(US, event(US, i, 1)) for i in range(5)])
    q = run(spark, tmp)
    assert q.recentProgress[0]["numInputRows"] == 25  # three tables, one read
    assert ids(scan_lake(spark, f"{tmp}/lake", "transactions")) == list(range(20))

    # Lost after the first table of the second batch.
    put(f"{tmp}/ev", 1, [(TX, event(TX, i, 3)) for i in range(20, 30)] + [(US, event(US, 9, 2))])
    real, calls = ingest.write_batch, []

    def lost(rows, lake, table, batch_id):
        calls.append(table)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(rows, lake, table, batch_id)

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_batch", lost)
        with pytest.raises(Exception, match="lost"):
            run(spark, tmp)
    assert len(ids(scan_lake(spark, f"{tmp}/lake", "transactions"))) == 30 and ids(scan_lake(spark, f"{tmp}/lake", "users")) == [0, 1, 2, 3, 4]
    seen = []
    monkeypatch.setattr(ingest, "write_batch", lambda *a: (seen.append((a[2], a[3])), real(*a)))
    run(spark, tmp)
    assert seen == [("users", 1), ("cards", 1)]  # the first table has the batch whole
    assert ids(scan_lake(spark, f"{tmp}/lake", "transactions")) == list(range(30))
    assert ids(scan_lake(spark, f"{tmp}/lake", "users")) == [0, 1, 2, 3, 4, 9]


def test_incomplete_batches_are_not_read_and_are_written_over(spark, tmp):
    rows = ingest.to_lake_rows(spark.createDataFrame([(TX, json.dumps(event(TX, i, 1))) for i in range(4)], "topic string, value string"),
                               ingest.select_topics("transactions")[0])
    lb.write_batch(rows, f"{tmp}/lake", "transactions", 0)
    lb.write_batch(rows, f"{tmp}/lake", "transactions", 1)
    os.remove(f"{tmp}/lake/transactions/batch=1/_SUCCESS")  # as a lost driver leaves it
    assert not lb.is_complete(spark, f"{tmp}/lake", "transactions", 1)
    assert lb.scan_batches(spark, f"{tmp}/lake", "transactions").count() == 4
    lb.write_batch(rows, f"{tmp}/lake", "transactions", 1)
    assert lb.scan_batches(spark, f"{tmp}/lake", "transactions").count() == 8
    assert lb.scan_batches(spark, f"{tmp}/lake", "users").count() == 0


def test_compaction(spark, tmp, monkeypatch):
    lake, route = f"{tmp}/lake", ingest.select_topics("transactions")[0]

    def batch(n, days):
        events = [(TX, json.dumps(event(TX, 100 * n + i, d))) for i, d in enumerate(days)]
        rows = ingest.to_lake_rows(spark.createDataFrame(events, "topic string, value string"), route)
        lb.write_batch(rows.repartition(4), lake, "transactions", n)

    for n in range(6):
        batch(n, [1 + n % 2, 1 + n % 2, 3])
    want = ids(lb.scan_batches(spark, lake, "transactions"))
    reader = lb.scan_batches(spark, lake, "transactions")  # planned before the compaction
    files_before = len(reader.inputFiles())
    assert lb.compact(spark, lake, "transactions") == 5
    after = lb.scan_batches(spark, lake, "transactions")
    assert ids(after) == want == ids(reader)
    assert len(after.inputFiles()) == 3 < files_before  # one per date
    assert after.filter("year = '2024' AND day = '03'").count() == 6
    parts = lb._compacted(spark, lake, "transactions").folders()
    batch(6, [3, 4])
    assert lb.scan_batches(spark, lake, "transactions").count() == len(want) + 2

    from scorewatch.sources.versioned import VersionedTable  # a compaction that is lost before it is published
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lb.compact(spark, lake, "transactions")
    assert lb.scan_batches(spark, lake, "transactions").count() == len(want) + 2
    assert lb.compact(spark, lake, "transactions") == 6 == lb.compact(spark, lake, "transactions")
    now = lb._compacted(spark, lake, "transactions").folders()
    assert {p for p in now if now[p] != parts.get(p)} == {"2024/01/03", "2024/01/04"}
    assert lb.expire(spark, lake, "transactions") == list(range(7)) and not glob.glob(f"{lake}/transactions/batch=*")
    assert len(ids(lb.scan_batches(spark, lake, "transactions"))) == len(want) + 2
    load_raw(spark, lake, f"{tmp}/none", f"{tmp}/raw", ["transactions"])
    assert ids(read_raw(spark, f"{tmp}/raw", "transactions")) == ids(scan_lake(spark, lake, "transactions"))


def test_a_batch_of_card_events_published_twice(spark, tmp):
    pages = [json.dumps({"page": p, "page_size": 2, "total": 4, "items": [{"card_id": 2 * p + i, "user_id": 1, "pan": "4111 1111 1111 1234",
             "cvv": "123", "exp_date": "01/30", "card_type": "visa", "cardholder": "ANA B."} for i in range(2)]}) for p in (1, 2)]
    first = spark.createDataFrame([(p,) for p in pages], "value string")
    again = spark.createDataFrame([(p,) for p in reversed(pages)], "value string").repartition(3)
    assert cards.batch_of(first) == cards.batch_of(again) != cards.batch_of(first.limit(1))
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    for df in (first, again, first.filter("value LIKE '%\"page\": 2%'")):
        cards.publish_card_events(cards.card_events(df, stamp), path=f"{tmp}/ev", batch=cards.batch_of(df))
    q = ingest.start_fanout(ingest.file_source(spark, f"{tmp}/ev"), f"{tmp}/lake", f"{tmp}/ck", "cards", available_now=True)
    q.awaitTermination()
    assert ids_of_cards(spark, tmp) == [2, 3, 4, 4, 5, 5]  # the third set is a batch of its own
    assert cards.batch_of(first.limit(0)).startswith("0-")


def ids_of_cards(spark, tmp):
    return sorted(r.card_id for r in scan_lake(spark, f"{tmp}/lake", "cards").collect())
