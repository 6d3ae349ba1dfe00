"""The entry points in a plain session, as a driver would create it: no UTC
zone, no checkpoint folder, default settings otherwise."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, REPO)
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "America/Sao_Paulo")
             .config("spark.ui.enabled", "false").getOrCreate())
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    ts = sorted(r.created_at for r in rows)
    q = E.queries()
    ids = q["movement_surrogate_id"](spark, "/root/testdata/sf0.001").select("id").collect()
    print(len(rows), ts[0].isoformat(), len(ids), min(i.id for i in ids), max(i.id for i in ids))
""").replace("REPO", repr(REPO))


def test_entry_in_plain_session():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    n, first_ts, n_ids, lo, hi = out.stdout.split()[-5:]
    assert n == "1000" and first_ts.startswith("2024-01-01T00:00")
    assert int(n_ids) == int(hi) and lo == "1"
