"""Raw warehouse tables derived from the shared test tables.

The source system's inputs (CDC users and transactions, the card feed, the
daily movement CSV) are derived deterministically from the TPC-H-like test
tables so that every query's work grows with them:

* users: all customers (three snapshot batches); some carry a status that
  does not fit their score,
* transactions: ``events`` with 30 days compressed into 6 hours (or as they
  are), plus re-deliveries,
* cards: one per customer, with re-deliveries, as a feed of pages,
* card movements: ``lineitem`` rows with the ordering customer's card and the
  supplier's nation.

All derivations are joins and projections; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scorewatch.functions.timecols import ntz
from scorewatch.sources.schemas import MONEY
from scorewatch.streaming import decode

# --- fixed values of the derivation -------------------------------------
USERS_EPOCH = "2023-12-01 00:00:00"      # batch-1 updated_at = epoch + key minutes
TX_EPOCH = "2024-01-01 00:00:00"         # events are compressed towards this time
TX_COMPRESSION = 120                     # 30 days -> 6 hours
BATCH2_UPDATED = "2024-01-01 03:00:00"   # batch-2 updated_at = this + key seconds
BATCH_RUN_AT = {2: "2024-01-01 03:30:00", 3: "2024-01-01 05:00:00"}
CARD_INGESTED = ("2024-01-01 00:00:00", "2024-01-01 00:05:00")
CARD_TYPES = ("visa", "mastercard", "amex", " ")
CARDHOLDERS = ("JUAN P.", "MARIA G.", "  ANA   M. ", "SOFIA", "")
WRONG_STATUS_EVERY = 41                  # users whose stored status is always "alto"
# -------------------------------------------------------------------------


# Schemas of the shared test tables we read (given, so no inference job runs).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _score(key: Column) -> Column:
    return (F.lit(300) + (key * 37) % 551).cast("int")


def _limit_for(score: Column, key: Column) -> Column:
    return (F.when(score >= 700, 200000 + (key * 7919) % 300001)
            .when(score >= 550, 50000 + (key * 7919) % 150000)
            .otherwise(1000 + (key * 7919) % 9000)).cast("double")


def _status_for(score: Column, key: Column) -> Column:
    return (F.when(key % WRONG_STATUS_EVERY == 0, F.lit("alto"))
            .when(score >= 700, F.lit(" Bajo"))
            .when(score >= 550, F.lit("MEDIO "))
            .otherwise(F.lit("alto")))


def all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with their nation."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select("c_custkey", "c_name", "c_nationkey", "n_name"))


def users_lake(spark: SparkSession, sf_dir: str, batch: int = 1, base: DataFrame | None = None) -> DataFrame:
    """User rows as the lake holds them at snapshot run ``batch`` (1, 2, 3).

    Batch 2 changes the score of every third user (limit and status follow
    the new score) with an updated_at inside the transaction span; batch 3 is
    batch 2 without the keys ``id % 50 = 7`` (hard deletes). ``base`` is
    :func:`all_users`; passing one frame to every batch lets Spark reuse
    its exchanges.
    """
    u = base if base is not None else all_users(spark, sf_dir)
    key = F.col("c_custkey")
    score1 = _score(key)
    if batch == 1:
        score = score1
        updated = F.timestamp_add("MINUTE", key, ntz(USERS_EPOCH))
    else:
        changed = key % 3 == 0
        score = F.when(changed, F.greatest(F.lit(300), F.least(F.lit(850), score1 + key % 121 - 60))
                       ).otherwise(score1).cast("int")
        updated = F.when(changed, F.timestamp_add("SECOND", key, ntz(BATCH2_UPDATED))
                         ).otherwise(F.timestamp_add("MINUTE", key, ntz(USERS_EPOCH)))
    out = u.select(
        key.alias("id"),
        F.when(key % 11 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
         .otherwise(F.col("c_name")).alias("nombre"),
        score.alias("scoring_crediticio"),
        _limit_for(score, key).alias("limite_credito"),
        _status_for(score, key).alias("status_riesgo"),
        F.col("n_name").alias("location"),
        updated.alias("updated_at"),
    )
    if batch == 3:
        out = out.filter(key % 50 != 7)
    return out


def users_raw(spark: SparkSession, sf_dir: str, batch: int = 1, base: DataFrame | None = None) -> DataFrame:
    """``raw.users`` for one batch: the lake rows typed by the raw loader."""
    lake = users_lake(spark, sf_dir, batch, base)
    return lake.select(
        "id", "nombre", F.col("scoring_crediticio").cast("int").alias("scoring_crediticio"),
        F.col("limite_credito").cast(MONEY).alias("limite_credito"),
        "status_riesgo", "location", "updated_at")


def transactions_lake(spark: SparkSession, sf_dir: str, compression: int = TX_COMPRESSION) -> DataFrame:
    """Transactions as the lake holds them (amount as double), including the
    re-delivered copies of every 50th id (amount + 1, one second later).
    ``compression``: how much faster than the events time passes; 1 keeps the
    events' own 30 days.

    The user's location comes from the event's customer and its nation (the
    same value batch-1 users carry); the join sides are planned from file
    sizes, so small dimensions are broadcast and large ones shuffled.
    """
    ev = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n_user = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("u_nationkey"), F.col("n_name").alias("u_location"))
    n_next = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("x_nationkey"), F.col("n_name").alias("x_location"))
    nations = table(spark, sf_dir, "nation").select(F.count(F.lit(1))).scalar()
    base = ntz(TX_EPOCH)
    shifted = F.timestamp_diff("MICROSECOND", base, F.col("ts"))
    t = (ev.join(customer, ev.user_id == customer.c_custkey, "left")
         .join(n_user, F.col("c_nationkey") == F.col("u_nationkey"), "left")
         .join(n_next, F.col("x_nationkey") == (F.col("c_nationkey") + 1) % nations, "left"))
    eid = F.col("event_id")
    t0 = t.select(
        eid.alias("id"), F.col("user_id"),
        (F.col("value") * 40).alias("amount"),
        F.col("event_type").alias("merchant_category"),
        F.when(eid % 97 == 0, F.lit("  ")).when(eid % 10 == 0, F.col("x_location"))
         .otherwise(F.col("u_location")).alias("location"),
        F.when(eid % 89 == 0, F.lit(None).cast("boolean"))
         .otherwise((F.col("event_type") == "error") & (eid % 4 == 0)).alias("is_flagged_fraud"),
        F.timestamp_add("MICROSECOND", F.floor(shifted / compression), base).alias("created_at"),
    )
    redelivered = t0.filter(F.col("id") % 50 == 0).select(
        "id", "user_id", (F.col("amount") + 1).alias("amount"), "merchant_category",
        "location", "is_flagged_fraud",
        F.timestamp_add("SECOND", F.lit(1), F.col("created_at")).alias("created_at"))
    return t0.unionByName(redelivered)


def transactions_raw(spark: SparkSession, sf_dir: str, compression: int = TX_COMPRESSION) -> DataFrame:
    """``raw.transactions``: the lake rows with amount typed numeric(15,2)."""
    lake = transactions_lake(spark, sf_dir, compression)
    return lake.withColumn("amount", F.col("amount").cast(MONEY))


def card_feed(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Raw cards as the card feed serves them (PAN and CVV in clear), one per
    customer plus a re-delivery at 00:05 for every fourth card.

    ``user_id = c_custkey % (number of users)``; the user count is a scalar
    subquery, evaluated once as its own job.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    n_users = (base if base is not None else all_users(spark, sf_dir)).select(F.count(F.lit(1))).scalar()
    k = F.col("c_custkey")
    cards = customer.select(
        k.alias("card_id"),
        (k % n_users).alias("user_id"),
        F.concat(F.lit("4"), F.lpad(((k * 7919) % 10000).cast("string"), 4, "0"),
                 F.lit(" 1234 5678 "), (1000 + k % 9000).cast("string")).alias("pan"),
        (100 + k % 900).cast("string").alias("cvv"),
        F.concat(F.lpad((1 + k % 12).cast("string"), 2, "0"), F.lit("/"),
                 (26 + k % 6).cast("string")).alias("exp_date"),
        F.element_at(F.array(*[F.lit(x) for x in CARD_TYPES]), (k % 4 + 1).cast("int")).alias("card_type"),
        F.element_at(F.array(*[F.lit(x) for x in CARDHOLDERS]), (k % 5 + 1).cast("int")).alias("cardholder"),
    )
    first = cards.withColumn("ingested_at", ntz(CARD_INGESTED[0]))
    again = cards.filter(k % 4 == 0).withColumn("ingested_at", ntz(CARD_INGESTED[1]))
    return first.unionByName(again)


def card_pages(cards: DataFrame, page_size: int) -> DataFrame:
    """The card feed as it is served: per delivery, pages of ``page_size``
    card ids (one page holds each id at most once)."""
    total = cards.select(F.count(F.lit(1))).scalar()
    page = (F.floor(F.col("card_id") / page_size) + 1).cast("long")
    item = F.struct(*[F.col(c) for c in ("card_id", "user_id", "pan", "cvv", "exp_date", "card_type", "cardholder")])
    grouped = cards.groupBy("ingested_at", page.alias("page")).agg(F.collect_list(item).alias("items"))
    return grouped.select(F.to_json(F.struct(
        "page", F.lit(page_size).cast("long").alias("page_size"), total.alias("total"), "items")).alias("value"))


def change_events(lake: DataFrame) -> DataFrame:
    """Transactions as change events: flat rows, envelopes, envelopes inside a
    payload, and deletes without a new state."""
    wire = decode.encode_transactions(lake)
    key = F.col("key").cast("long")
    op = F.when(key % 2 == 0, "c").otherwise("u")
    envelope = F.concat(F.lit('{"before":null,"after":'), F.col("value"), F.lit(',"op":"'), op, F.lit('"}'))
    return wire.select("key", F.when(key % 59 == 0, F.lit('{"before":{"id":1},"after":null,"op":"d"}'))
                       .when(key % 3 == 0, F.col("value")).when(key % 3 == 1, envelope)
                       .otherwise(F.concat(F.lit('{"schema":{},"payload":'), envelope, F.lit("}"))).alias("value"))


def card_movements_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily movement rows as the landing CSV holds them, with the
    ``source_date`` the loader takes from the file's folder name."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey, "left")
         .join(sup, li.l_suppkey == sup.s_suppkey, "left")
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    return j.select(
        F.col("o_custkey").alias("card_id"),
        F.col("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.col("l_returnflag"))
         .alias("merchant_category"),
        F.col("n_name").alias("location"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("source_date"),
    )
