"""Command line: the jobs of the pipeline and the served queries.

    python -m scorewatch ingest  --events DIR | --bootstrap HOST  --lake DIR --checkpoint DIR [--topic X] [--once]
    python -m scorewatch compact --lake DIR [--single t1,t2] [--expire]
    python -m scorewatch cards   --pages DIR (--events DIR | --bootstrap HOST) [--max-pages N]
    python -m scorewatch load    --lake DIR --landing DIR --raw DIR [--single t1,t2]
    python -m scorewatch sync    --lake DIR --raw DIR --checkpoint DIR [--single t1,t2]
    python -m scorewatch build   --raw DIR --out DIR [--run-at 'YYYY-MM-DD HH:MM:SS']
    python -m scorewatch update  --deliveries DIR --users DIR --out DIR [--run-at 'YYYY-MM-DD HH:MM:SS'] [--compact]
    python -m scorewatch report  --out DIR
    python -m scorewatch serve   QUERY --out DIR [--user N] [--limit N] [--hours N] [--as-of TS] [--write DIR]
    python -m scorewatch sql     "SELECT ... FROM marts.fct_fraud_alerts ..." --out DIR [--database marts] [--write DIR]

Served queries: credit-score, credit-score-current, alerts, alerts-summary,
fraud-by-hour, fraud-by-day, score-distribution, feed, alerts-by-rule.
The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
settings apply); the session zone is set to UTC.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewatch.functions import constants as K
from scorewatch.session import configure


def _session() -> SparkSession:
    return configure(SparkSession.builder.appName("scorewatch").getOrCreate())


def _as_of(text: str | None):
    return F.lit(text).cast("timestamp_ntz") if text else F.current_timestamp().cast("timestamp_ntz")


def _emit(df: DataFrame, write: str | None, show: int | None = None) -> int:
    """Print the rows as JSON lines, partition by partition, or write them;
    returns the number of rows printed (-1 when written). An explicit ``show``
    stops there and says so if rows are left."""
    if write:
        df.write.mode("overwrite").parquet(write)
        print(json.dumps({"written": write}))
        return -1
    n = 0
    for row in df.toJSON().toLocalIterator():
        if n == show:
            print(json.dumps({"truncated": f"only the first {show} rows are shown"}), file=sys.stderr)
            break
        print(row)
        n += 1
    return n


def serve_updated(spark: SparkSession, args) -> DataFrame:
    """The same queries from the tables that ``update`` keeps: lookups open the
    user's buckets, lists the newest dates, rates the hourly rollup."""
    from scorewatch.plans import marts, newest, rollup, serving
    from scorewatch.plans.incremental import IncrementalBuild
    build = IncrementalBuild(spark, args.out)
    users = [args.user] if args.user is not None else None
    q = args.query
    if q in ("credit-score", "credit-score-current"):
        history = q == "credit-score"
        rows = build.snapshot.of_users(users, history) if users else build.snapshot.read() if history else build.snapshot.current()
        dim = marts.dim_users(rows)
        return serving.credit_score_history(dim) if history else serving.credit_score_current(dim)
    if q == "score-distribution":
        return serving.score_distribution(marts.dim_users(build.snapshot.current()))
    alerts, hours = build.tables["fct_fraud_alerts"], build.tables["alerts_hourly"]
    if q == "alerts":
        return newest.active_alerts(alerts, K.ALERTS_LIMIT_DEFAULT if args.limit is None else args.limit, args.user)
    if q == "feed":
        limit = K.FEED_LIMIT if args.limit is None else args.limit
        if args.minutes:
            return serving.alert_feed(alerts.read(), limit, _as_of(args.as_of), args.minutes)
        return newest.alert_feed(alerts, limit)
    if q == "alerts-summary":
        return rollup.fraud_summary(hours.read(), _as_of(args.as_of),
                                    K.SUMMARY_HOURS_DEFAULT if args.hours is None else args.hours, alerts.read())
    panels = {"fraud-by-hour": rollup.fraud_pct_by_hour, "fraud-by-day": rollup.fraud_pct_by_day, "alerts-by-rule": rollup.alerts_by_rule}
    if q in panels:
        return panels[q](hours.read())
    raise SystemExit(f"unknown query {q!r}")


def serve(spark: SparkSession, args) -> DataFrame:
    if args.updated:
        return serve_updated(spark, args)
    from scorewatch.plans import serving
    from scorewatch.plans.pipeline import read_published
    out = args.out.rstrip("/")
    dim = read_published(spark, f"{out}/marts/dim_users")
    alerts = read_published(spark, f"{out}/marts/fct_fraud_alerts")
    users = [args.user] if args.user is not None else None
    q = args.query
    if q == "credit-score":
        return serving.credit_score_history(dim, users)
    if q == "credit-score-current":
        return serving.credit_score_current(dim, users)
    if q == "alerts":
        return serving.active_alerts(alerts, K.ALERTS_LIMIT_DEFAULT if args.limit is None else args.limit, args.user)
    if q == "alerts-summary":
        return serving.fraud_summary(alerts, _as_of(args.as_of), K.SUMMARY_HOURS_DEFAULT if args.hours is None else args.hours)
    if q == "fraud-by-hour":
        return serving.fraud_pct_by_hour(alerts)
    if q == "fraud-by-day":
        return serving.fraud_pct_by_day(alerts)
    if q == "score-distribution":
        return serving.score_distribution(dim)
    if q == "feed":
        minutes = args.minutes
        return serving.alert_feed(alerts, K.FEED_LIMIT if args.limit is None else args.limit,
                                  _as_of(args.as_of) if minutes else None, minutes)
    if q == "alerts-by-rule":
        return serving.alerts_by_rule(alerts)
    raise SystemExit(f"unknown query {q!r}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="scorewatch")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("ingest", help="stream topics into the date-partitioned lake")
    a.add_argument("--events"), a.add_argument("--bootstrap")
    a.add_argument("--lake", required=True), a.add_argument("--checkpoint", required=True)
    a.add_argument("--topic"), a.add_argument("--once", action="store_true")
    a.add_argument("--max-offsets", type=int, help="broker offsets per topic and trigger (default: all)")
    a.add_argument("--fanout", action="store_true", help="read the source once for all tables, batch by batch")

    co = sub.add_parser("compact", help="bring the batches of a fan-out lake together by date")
    co.add_argument("--lake", required=True), co.add_argument("--single")
    co.add_argument("--expire", action="store_true", help="remove the batch folders that are compacted")

    c = sub.add_parser("cards", help="card feed pages -> anonymized card events")
    c.add_argument("--pages", required=True), c.add_argument("--events"), c.add_argument("--bootstrap")
    c.add_argument("--max-pages", type=int, help="process pages 1..N only (default: all)")

    lo = sub.add_parser("load", help="full refresh of the raw tables")
    lo.add_argument("--lake", required=True), lo.add_argument("--landing", required=True)
    lo.add_argument("--raw", required=True), lo.add_argument("--single")

    sy = sub.add_parser("sync", help="incremental raw load of the lake tables (new files only)")
    sy.add_argument("--lake", required=True), sy.add_argument("--raw", required=True)
    sy.add_argument("--checkpoint", required=True), sy.add_argument("--single")

    b = sub.add_parser("build", help="snapshot, velocity, marts and the data-quality report")
    b.add_argument("--raw", required=True), b.add_argument("--out", required=True), b.add_argument("--run-at")

    u = sub.add_parser("update", help="bring the tables up to new deliveries and the users as they are: changed dates only")
    u.add_argument("--deliveries", required=True, help="raw transactions (Parquet) since the last update")
    u.add_argument("--users", required=True, help="raw users (Parquet), all of them")
    u.add_argument("--out", required=True), u.add_argument("--run-at")
    u.add_argument("--compact", action="store_true", help="then move closed score versions to their users' buckets")

    r = sub.add_parser("report", help="print the data-quality report")
    r.add_argument("--out", required=True)

    s = sub.add_parser("serve", help="run a served query over the marts")
    s.add_argument("query"), s.add_argument("--out", required=True)
    s.add_argument("--updated", action="store_true", help="from the tables of 'update' instead of 'build'")
    s.add_argument("--user", type=int), s.add_argument("--limit", type=int)
    s.add_argument("--hours", type=int), s.add_argument("--minutes", type=int)
    s.add_argument("--as-of"), s.add_argument("--write"), s.add_argument("--show", type=int)

    q = sub.add_parser("sql", help="run SQL over the published tables (database.table)")
    q.add_argument("statement"), q.add_argument("--out", required=True)
    q.add_argument("--database", default="marts"), q.add_argument("--write")
    q.add_argument("--show", type=int)

    args = p.parse_args(argv)
    spark = _session()

    if args.cmd == "ingest":
        from scorewatch.streaming import ingest
        if args.fanout:
            if args.bootstrap:
                sources = [ingest.kafka_source(spark, args.bootstrap, r.topic, args.max_offsets) for r in ingest.select_topics(args.topic)]
                events = sources[0]
                for more in sources[1:]:
                    events = events.unionByName(more)
            elif args.events:
                events = ingest.file_source(spark, args.events)
            else:
                raise SystemExit("give --events or --bootstrap")
            queries = [ingest.start_fanout(events, args.lake, args.checkpoint, args.topic, args.once)]
        elif args.bootstrap:
            queries = []
            for route in ingest.select_topics(args.topic):
                src = ingest.kafka_source(spark, args.bootstrap, route.topic, args.max_offsets)
                queries += ingest.start_ingest(src, args.lake, args.checkpoint, route.topic, args.once)
        elif args.events:
            queries = ingest.start_ingest(ingest.file_source(spark, args.events), args.lake,
                                          args.checkpoint, args.topic, args.once)
        else:
            raise SystemExit("give --events or --bootstrap")
        for q in queries:
            q.awaitTermination()
    elif args.cmd == "compact":
        from scorewatch.sources import lake_batches
        from scorewatch.sources.schemas import LAKE
        tables = args.single.split(",") if args.single else list(LAKE)
        print(json.dumps({t: lake_batches.compact(spark, args.lake, t) for t in tables}))
        if args.expire:
            print(json.dumps({t: lake_batches.expire(spark, args.lake, t) for t in tables}))
    elif args.cmd == "cards":
        from scorewatch.streaming import cards
        pages = spark.read.text(args.pages, wholetext=True)
        # The same pages are the same batch: a second run leaves one set of events.
        cards.publish_card_events(cards.card_events(pages, max_pages=args.max_pages), bootstrap=args.bootstrap,
                                  path=args.events, batch=cards.batch_of(pages))
    elif args.cmd == "load":
        from scorewatch.sources.lake import load_raw
        tables = args.single.split(",") if args.single else None
        print(json.dumps(load_raw(spark, args.lake, args.landing, args.raw, tables)))
    elif args.cmd == "sync":
        from scorewatch.sources.lake import sync_raw
        tables = args.single.split(",") if args.single else ("transactions", "users", "cards")
        print(json.dumps(sync_raw(spark, args.lake, args.raw, args.checkpoint, tables)))
    elif args.cmd == "build":
        from scorewatch.plans.pipeline import build_all
        print(json.dumps(build_all(spark, args.raw, args.out, _as_of(args.run_at))))
    elif args.cmd == "update":
        from scorewatch.plans.incremental import IncrementalBuild
        from scorewatch.sources.schemas import RAW
        build = IncrementalBuild(spark, args.out)
        dates = build.apply(spark.read.schema(RAW["transactions"]).parquet(args.deliveries),
                            spark.read.schema(RAW["users"]).parquet(args.users), _as_of(args.run_at))
        if args.compact:
            build.snapshot.compact()
        print(json.dumps({"dates": [None if d is None else str(d) for d in dates]}))
    elif args.cmd == "report":
        from scorewatch.plans.pipeline import read_published
        _emit(read_published(spark, f"{args.out.rstrip('/')}/reports/dq_report"), None)
    elif args.cmd == "serve":
        shown = _emit(serve(spark, args), args.write, args.show)
        if shown == 0 and args.user is not None and args.query.startswith("credit-score"):
            # The served API answered "not found" for an unknown user.
            print(json.dumps({"error": f"user {args.user} not found"}), file=sys.stderr)
            return 1
    elif args.cmd == "sql":
        from scorewatch.plans.pipeline import register_tables
        register_tables(spark, args.out, args.database)
        _emit(spark.sql(args.statement), args.write, args.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())
