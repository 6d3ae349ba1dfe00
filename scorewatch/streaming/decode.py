"""Decode keyed JSON events into lake rows.

Works on any frame with a string ``value`` column, batch or streaming.
Per-table policy, as the sink has it:

* transactions: drop on NULL/empty value, malformed JSON, a value that is
  not an object, missing or invalid ``created_at``, or a non-numeric amount;
  a missing fraud flag is false;
* users: drop on malformed JSON or invalid ``updated_at``; an invalid limit
  becomes NULL and the row is kept;
* cards: drop on malformed JSON or invalid ``ingested_at``.

Change-data envelopes are flattened to the new row state: a value with an
``after`` object (optionally inside ``payload``) is replaced by it; deletes
(``op = 'd'`` or no new state) are dropped. Flat values pass unchanged.
Timestamps are ISO-8601: ``Z`` and offsets are honoured, naive text is UTC,
and the result is the UTC wall clock as ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scorewatch.sources.schemas import LAKE_CARD, LAKE_TRANSACTION, LAKE_USER, WIRE_CARD, \
    WIRE_TRANSACTION, WIRE_USER

#: The usual form, which Spark's cast reads as it is.
_ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
#: Any ISO-8601 calendar form: with or without separators, any one character
#: before the time, hours alone, a point or comma before any number of decimals.
_ISO_ANY = (r"(?s)^(\d{4})(-?)(\d{2})\2(\d{2})(?:Z|.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
            r"(?:Z|([+-]\d{2})(?::?(\d{2}))?)?)?$")
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"

_ENVELOPE = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("payload", T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("after", T.StringType()),
    ])),
])


def parse_iso_ts(c: Column) -> Column:
    """ISO-8601 text to UTC ``timestamp_ntz``; anything else is NULL. Decimals
    beyond microseconds are cut off."""
    group = lambda i: F.regexp_extract(c, _ISO_ANY, i)
    or_00 = lambda i: F.when(group(i) == "", "00").otherwise(group(i))
    spelt = F.concat(group(1), F.lit("-"), group(3), F.lit("-"), group(4), F.lit("T"), or_00(5), F.lit(":"), or_00(7), F.lit(":"), or_00(8),
                     F.lit("."), F.rpad(F.substring(group(9), 1, 6), 6, "0"),
                     F.when(group(10) == "", "Z").otherwise(F.concat(group(10), F.lit(":"), or_00(11))))
    text = F.when(c.rlike(_ISO_PLAIN), c).when(c.rlike(_ISO_ANY), spelt)
    return text.try_cast("timestamp").cast("timestamp_ntz")


def parse_number(c: Column) -> Column:
    """Decimal text (or nan/inf) to double; anything else is NULL."""
    return F.when(F.lower(c).rlike(_NUMBER), c.try_cast("double"))


def unwrap_cdc(values: DataFrame) -> DataFrame:
    """Replace change-data envelopes by their new row state.

    Accepted: a flat row; ``{before, after, op}``; the same inside
    ``payload``; and a flat row inside ``payload`` (converter with schemas).
    """
    env = F.from_json(F.col("value"), _ENVELOPE)
    payload_row = F.when(env["payload"].isNotNull() & env["payload"]["after"].isNull()
                         & env["payload"]["op"].isNull(),
                         F.get_json_object(F.col("value"), "$.payload"))
    after = F.coalesce(env["after"], env["payload"]["after"], payload_row)
    op = F.coalesce(env["op"], env["payload"]["op"])
    is_env = after.isNotNull() | op.isNotNull()
    tagged = values.withColumn("_env", F.struct(after.alias("after"), op.alias("op"), is_env.alias("is_env")))
    # Envelopes without a new state (deletes) are dropped; flat rows pass.
    has_state = F.col("_env.after").isNotNull() & (F.coalesce(F.col("_env.op"), F.lit("")) != "d")
    return (tagged.filter(~F.col("_env.is_env") | has_state)
            .withColumn("value", F.when(F.col("_env.is_env"), F.col("_env.after")).otherwise(F.col("value")))
            .drop("_env"))


def _objects(values: DataFrame, schema: T.StructType) -> DataFrame:
    v = F.col("value").cast("string")
    is_obj = F.trim(v).startswith("{")
    keep = [c for c in values.columns if c != "value"]
    return (values.filter(v.isNotNull() & (F.trim(v) != "") & is_obj)
            .select(*keep, F.from_json(v, schema).alias("r")))


def decode_transactions(values: DataFrame) -> DataFrame:
    d = _objects(values, WIRE_TRANSACTION)
    ts = parse_iso_ts(F.col("r.created_at"))
    amount = parse_number(F.col("r.amount"))
    out = d.select(
        *[c for c in d.columns if c != "r"],
        F.col("r.id").alias("id"), F.col("r.user_id").alias("user_id"), amount.alias("amount"),
        F.col("r.merchant_category").alias("merchant_category"), F.col("r.location").alias("location"),
        F.coalesce(F.col("r.is_flagged_fraud"), F.lit(False)).alias("is_flagged_fraud"),
        ts.alias("created_at"))
    return out.filter(F.col("created_at").isNotNull() & F.col("amount").isNotNull())


def decode_users(values: DataFrame) -> DataFrame:
    d = _objects(values, WIRE_USER)
    out = d.select(
        *[c for c in d.columns if c != "r"],
        F.col("r.id").alias("id"), F.col("r.nombre").alias("nombre"),
        F.col("r.scoring_crediticio").alias("scoring_crediticio"),
        parse_number(F.col("r.limite_credito")).alias("limite_credito"),
        F.col("r.status_riesgo").alias("status_riesgo"), F.col("r.location").alias("location"),
        parse_iso_ts(F.col("r.updated_at")).alias("updated_at"))
    return out.filter(F.col("updated_at").isNotNull())


def decode_cards(values: DataFrame) -> DataFrame:
    d = _objects(values, WIRE_CARD)
    out = d.select(
        *[c for c in d.columns if c != "r"],
        *[F.col(f"r.{c}").alias(c) for c in LAKE_CARD.fieldNames() if c != "ingested_at"],
        parse_iso_ts(F.col("r.ingested_at")).alias("ingested_at"))
    return out.filter(F.col("ingested_at").isNotNull())


def iso_utc(c: Column) -> Column:
    """``timestamp_ntz`` (UTC wall clock) to ISO-8601 text with ``Z``."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def encode_transactions(lake: DataFrame) -> DataFrame:
    """Lake transactions as flat change-event JSON, amount as decimal text
    (the wire form of a numeric column)."""
    payload = F.struct(
        "id", "user_id", F.col("amount").cast("decimal(15,2)").cast("string").alias("amount"),
        "merchant_category", "location", "is_flagged_fraud", iso_utc(F.col("created_at")).alias("created_at"))
    return lake.select(F.col("id").cast("string").alias("key"), F.to_json(payload).alias("value"))


def encode_users(lake: DataFrame) -> DataFrame:
    payload = F.struct(
        "id", "nombre", "scoring_crediticio",
        F.col("limite_credito").cast("decimal(15,2)").cast("string").alias("limite_credito"),
        "status_riesgo", "location", iso_utc(F.col("updated_at")).alias("updated_at"))
    return lake.select(F.col("id").cast("string").alias("key"), F.to_json(payload).alias("value"))


DECODERS = {
    "transactions": (decode_transactions, LAKE_TRANSACTION, "created_at"),
    "users": (decode_users, LAKE_USER, "updated_at"),
    "cards": (decode_cards, LAKE_CARD, "ingested_at"),
}
