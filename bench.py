"""Benchmark: headline queries on the test tables.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_SHUFFLE_PARTITIONS`` (default 2 x cpus), ``BENCH_RUNS`` (timed runs per query after one warm-up, default
5; the median is reported). Each run computes the full result from the
parquet tables and discards it through the ``noop`` sink (no collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scorewatch.plans.catalog import QUERIES  # noqa: E402
from scorewatch.session import local_session  # noqa: E402

HEADLINE = (
    "fct_fraud_alerts",
    "user_transaction_velocity",
    "scd2_snapshot",
    "fraud_pct_by_hour",
    "fct_transactions_asof",
    "movement_surrogate_id",
    "dq_report",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    spark = local_session(cpus, shuffle_partitions=parts, app="scorewatch-bench")
    per_query = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, broadcast stats
        per_query[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": parts,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
