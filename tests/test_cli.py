"""The job commands end to end on a few events."""

import contextlib
import io
import json
import os

from scorewatch.__main__ import main


def _write_events(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        for topic, value in rows:
            f.write(json.dumps({"topic": topic, "key": str(value.get("id")), "value": json.dumps(value)}) + "\n")


def test_job_commands(spark, tmp):
    ev, lake, ck, raw, inc, out = (f"{tmp}/{x}" for x in ("ev", "lake", "ck", "raw", "inc", "out"))
    users = [("postgres_oltp.public.users", {"id": i, "nombre": f"U{i}", "scoring_crediticio": 500 + 100 * i,
                                              "limite_credito": "1000.00", "status_riesgo": "medio",
                                              "location": "A", "updated_at": "2024-01-01T00:00:00Z"})
             for i in range(3)]
    txs = [("postgres_oltp.public.transactions", {"id": 10 + i, "user_id": i % 3, "amount": str(2000 * i),
                                                  "merchant_category": "m", "location": "A" if i % 2 else "B",
                                                  "is_flagged_fraud": False,
                                                  "created_at": f"2024-01-01T00:0{i}:00Z"}) for i in range(6)]
    _write_events(ev, users + txs)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        main(["ingest", "--events", ev, "--lake", lake, "--checkpoint", ck, "--once"])
        main(["load", "--lake", lake, "--landing", f"{tmp}/no-landing", "--raw", raw])
        main(["sync", "--lake", lake, "--raw", inc, "--checkpoint", ck, "--single", "transactions,users"])
        main(["build", "--raw", raw, "--out", out, "--run-at", "2024-01-01 01:00:00"])
        main(["serve", "alerts-summary", "--out", out, "--as-of", "2024-01-01 01:00:00", "--hours", "2"])
        main(["serve", "score-distribution", "--out", out])
        main(["sql", "SELECT count(*) AS n, count_if(is_fraud_alert) AS a FROM marts.fct_fraud_alerts", "--out", out])
    lines = buf.getvalue().splitlines()
    loaded = json.loads(lines[0])
    assert set(loaded) == {"transactions", "users", "cards", "card_movements"}
    assert set(json.loads(lines[1])) == {"transactions", "users"}
    summary = json.loads(lines[3])
    assert summary["tx_total"] == 6 and summary["tx_con_alertas"] >= 3
    assert spark.read.parquet(f"{inc}/transactions").count() == 6
    last = json.loads(lines[-1])
    assert last["n"] == 6 and last["a"] == summary["tx_con_alertas"]


def test_update_and_serve(spark, tmp):
    """Two updates, then each served query from the tables they keep."""
    import datetime as dt
    from decimal import Decimal

    from scorewatch.sources.schemas import RAW
    users = [(i, f"U{i}", 500 + 100 * i, Decimal(1000), "medio", "A", dt.datetime(2024, 1, 1)) for i in range(3)]
    txs = [(10 + i, i % 3, Decimal(2000 * i), "m", "A" if i % 2 else "B", False, dt.datetime(2024, 1, 1 + i // 3, 0, i)) for i in range(6)]
    spark.createDataFrame(users, RAW["users"]).write.parquet(f"{tmp}/users")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        for n, part in enumerate((txs[:3], txs[3:])):
            spark.createDataFrame(part, RAW["transactions"]).write.parquet(f"{tmp}/new{n}")
            main(["update", "--deliveries", f"{tmp}/new{n}", "--users", f"{tmp}/users", "--out", f"{tmp}/out",
                  "--run-at", f"2024-01-0{n + 2} 01:00:00", "--compact"])
        for q in ("alerts", "feed", "alerts-by-rule", "fraud-by-day", "score-distribution"):
            print(f"# {q}")
            main(["serve", q, "--out", f"{tmp}/out", "--updated"])
        print("# summary")
        main(["serve", "alerts-summary", "--out", f"{tmp}/out", "--updated", "--as-of", "2024-01-02 00:30:00", "--hours", "2"])
        print("# user")
        assert main(["serve", "credit-score", "--out", f"{tmp}/out", "--updated", "--user", "2"]) == 0
        assert main(["serve", "credit-score-current", "--out", f"{tmp}/out", "--updated", "--user", "99"]) == 1
    head, *parts = buf.getvalue().split("# ")
    assert [json.loads(x)["dates"] for x in head.splitlines()] == [["2024-01-01"], ["2024-01-02"]]
    got = {p.splitlines()[0]: [json.loads(x) for x in p.splitlines()[1:]] for p in parts}
    assert [r["transaction_id"] for r in got["alerts"]] == [15, 14, 13, 12, 11, 10][:len(got["alerts"])] and len(got["feed"]) == len(got["alerts"])
    assert [r["tx_total"] for r in got["fraud-by-day"]] == [3, 3] and [r["tx_total"] for r in got["summary"]] == [3]
    assert len(got["alerts-by-rule"]) == 5 and sum(r["usuarios"] for r in got["score-distribution"]) == 3
    assert [r["user_id"] for r in got["user"]] == [2]
