"""Card feed: explode pages, mask, drop secrets, publish.

Raw PAN and CVV exist only inside the projection below: the anonymized frame
is built before any write, cache or checkpoint, and holds neither column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scorewatch.functions.text import mask_cardholder, mask_pan
from scorewatch.sources.schemas import FEED_PAGE
from scorewatch.streaming.decode import iso_utc

ANON_COLS = ("card_id", "user_id", "pan_last_masked", "card_type", "cardholder_masked",
             "exp_date", "ingested_at")


def explode_pages(pages: DataFrame, value_col: str = "value", max_pages: int | None = None) -> DataFrame:
    """Card-feed page JSON ``{page, page_size, total, items[]}`` -> one row
    per card (S10); ``max_pages`` keeps pages 1..max_pages only."""
    p = pages.select(F.from_json(F.col(value_col), FEED_PAGE).alias("p"))
    if max_pages:
        p = p.filter(F.col("p.page") <= max_pages)
    return p.select(F.inline(F.coalesce(F.col("p.items"), F.array().cast(FEED_PAGE["items"].dataType))))


def anonymize(cards: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Mask PAN and cardholder, drop CVV, stamp ``ingested_at``.

    ``ingested_at`` defaults to the row's own column when present, else the
    current time.
    """
    if ingested_at is None:
        ingested_at = (F.col("ingested_at") if "ingested_at" in cards.columns
                       else F.current_timestamp().cast("timestamp_ntz"))
    return cards.select(
        "card_id", "user_id",
        mask_pan(F.col("pan")).alias("pan_last_masked"),
        "card_type",
        mask_cardholder(F.col("cardholder")).alias("cardholder_masked"),
        "exp_date",
        ingested_at.cast("timestamp_ntz").alias("ingested_at"))


def encode_card_events(anon: DataFrame) -> DataFrame:
    """Keyed events for the card topic: key = card id text, value = JSON (K6)."""
    payload = F.struct(*[F.col(c) for c in ANON_COLS if c != "ingested_at"],
                       iso_utc(F.col("ingested_at")).alias("ingested_at"))
    return anon.select(F.col("card_id").cast("string").alias("key"), F.to_json(payload).alias("value"))


CARD_TOPIC = "cards.api"


def card_events(pages: DataFrame, ingested_at: Column | None = None,
                max_pages: int | None = None) -> DataFrame:
    """Feed pages -> keyed, anonymized card events ``topic, key, value``.
    PAN and CVV never leave this projection."""
    anon = anonymize(explode_pages(pages, max_pages=max_pages), ingested_at)
    return encode_card_events(anon).select(F.lit(CARD_TOPIC).alias("topic"), "key", "value")


def batch_of(pages: DataFrame, value_col: str = "value") -> str:
    """A name for a set of feed pages that follows from their content, in
    whatever order and files they come."""
    row = pages.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(value_col)).alias("x"),
                    F.sum(F.crc32(F.coalesce(F.col(value_col), F.lit("")).cast("binary"))).alias("c")).first()
    return f"{row['n']}-{(row['x'] or 0) & ((1 << 64) - 1):016x}-{row['c'] or 0}"


def publish_card_events(events: DataFrame, bootstrap: str | None = None, path: str | None = None,
                        batch: str | None = None) -> None:
    """Write card events to the broker topic, or as JSON lines to ``path``.
    With ``batch`` they are the events of that batch: in a folder of their own,
    written over what an earlier run of the same batch left, so that publishing a
    batch twice gives one set of events (a broker gets them again; the decoded
    cards keep one row per card)."""
    if bootstrap:
        (events.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).option("topic", CARD_TOPIC).save())
    elif path and batch is not None:
        events.write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch}")
    elif path:
        events.write.mode("append").json(path)
    else:
        raise ValueError("give a broker or a path")
