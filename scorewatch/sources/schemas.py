"""Explicit schemas for every layer; nothing is inferred.

Layers: wire JSON (decoded by ``streaming.decode``), lake Parquet (amounts as
double, UTC wall-clock timestamps), raw warehouse tables (typed with
decimal(15,2)), and the landing CSV (five positional columns).
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
TS = T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Wire payloads (flat JSON after CDC unwrap). Amount and limit come as text or
# number; they are decoded as strings and parsed explicitly.
WIRE_TRANSACTION = _s(
    ("id", T.LongType()), ("user_id", T.LongType()), ("amount", T.StringType()),
    ("merchant_category", T.StringType()), ("location", T.StringType()),
    ("is_flagged_fraud", T.BooleanType()), ("created_at", T.StringType()))

WIRE_USER = _s(
    ("id", T.LongType()), ("nombre", T.StringType()),
    ("scoring_crediticio", T.LongType()), ("limite_credito", T.StringType()),
    ("status_riesgo", T.StringType()), ("location", T.StringType()),
    ("updated_at", T.StringType()))

WIRE_CARD = _s(
    ("card_id", T.LongType()), ("user_id", T.LongType()),
    ("pan_last_masked", T.StringType()), ("card_type", T.StringType()),
    ("cardholder_masked", T.StringType()), ("exp_date", T.StringType()),
    ("ingested_at", T.StringType()))

# Raw card as served by the card feed (sensitive: never written).
FEED_CARD = _s(
    ("card_id", T.LongType()), ("user_id", T.LongType()), ("pan", T.StringType()),
    ("cvv", T.StringType()), ("exp_date", T.StringType()),
    ("card_type", T.StringType()), ("cardholder", T.StringType()))

FEED_PAGE = T.StructType([
    T.StructField("page", T.LongType()), T.StructField("page_size", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("items", T.ArrayType(FEED_CARD)),
])

# Lake (Parquet written by the ingest stream).
LAKE_TRANSACTION = _s(
    ("id", T.LongType()), ("user_id", T.LongType()), ("amount", T.DoubleType()),
    ("merchant_category", T.StringType()), ("location", T.StringType()),
    ("is_flagged_fraud", T.BooleanType()), ("created_at", TS))

LAKE_CARD = _s(
    ("card_id", T.LongType()), ("user_id", T.LongType()),
    ("pan_last_masked", T.StringType()), ("card_type", T.StringType()),
    ("cardholder_masked", T.StringType()), ("exp_date", T.StringType()),
    ("ingested_at", TS))

LAKE_USER = _s(
    ("id", T.LongType()), ("nombre", T.StringType()),
    ("scoring_crediticio", T.LongType()), ("limite_credito", T.DoubleType()),
    ("status_riesgo", T.StringType()), ("location", T.StringType()),
    ("updated_at", TS))

# Raw warehouse tables.
RAW_TRANSACTIONS = _s(
    ("id", T.LongType()), ("user_id", T.LongType()), ("amount", MONEY),
    ("merchant_category", T.StringType()), ("location", T.StringType()),
    ("is_flagged_fraud", T.BooleanType()), ("created_at", TS))

RAW_USERS = _s(
    ("id", T.LongType()), ("nombre", T.StringType()),
    ("scoring_crediticio", T.IntegerType()), ("limite_credito", MONEY),
    ("status_riesgo", T.StringType()), ("location", T.StringType()),
    ("updated_at", TS))

RAW_CARDS = LAKE_CARD

RAW_CARD_MOVEMENTS = _s(
    ("id", T.LongType()), ("card_id", T.LongType()), ("date", TS),
    ("amount", MONEY), ("merchant_category", T.StringType()),
    ("location", T.StringType()), ("source_date", T.StringType()),
    ("sourced_from", T.StringType()))

RAW = {
    "transactions": RAW_TRANSACTIONS,
    "users": RAW_USERS,
    "cards": RAW_CARDS,
    "card_movements": RAW_CARD_MOVEMENTS,
}

LAKE = {
    "transactions": LAKE_TRANSACTION,
    "users": LAKE_USER,
    "cards": LAKE_CARD,
}


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns from ``df`` in order, cast to its types;
    missing columns become typed NULLs."""
    from pyspark.sql import functions as F
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
