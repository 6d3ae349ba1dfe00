"""Stream -> lake sink.

One Structured Streaming query per table: it reads that table's topic,
flattens change-data envelopes (CDC topics only), decodes, adds the event
date as zero-padded ``year/month/day`` strings and appends Parquet
partitioned by them. The file sink and the checkpoint give exactly-once
files: a stopped query resumes from its checkpoint and replays only the
unfinished micro-batch. Late events simply land in their own date's
partition. :func:`start_fanout` reads the source once for all tables instead.

Sources are pluggable: :func:`kafka_source` for a broker (needs the Kafka
connector on the classpath), :func:`file_source` for JSON-lines files with
``topic, key, value`` (tests, replays).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from scorewatch.functions import constants as K
from scorewatch.sources.lake_batches import is_complete, write_batch
from scorewatch.streaming.decode import DECODERS, unwrap_cdc

# --- fixed values: topics and the table each feeds ------------------------
TOPICS = {
    "postgres_oltp.public.transactions": "transactions",
    "postgres_oltp.public.users": "users",
    "cards.api": "cards",
}
CDC_TOPICS = ("postgres_oltp.public.transactions", "postgres_oltp.public.users")
# -------------------------------------------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class Route:
    topic: str
    table: str
    decoder: Callable[[DataFrame], DataFrame]
    time_col: str
    cdc: bool


def select_topics(selector: str | None = None) -> list[Route]:
    """Routes for every topic, or those whose name contains ``selector``."""
    routes = [Route(t, tbl, DECODERS[tbl][0], DECODERS[tbl][2], t in CDC_TOPICS)
              for t, tbl in TOPICS.items() if selector is None or selector in t]
    if not routes:
        raise ValueError(f"no topic matches {selector!r}")
    return routes


def kafka_source(spark: SparkSession, bootstrap: str, topic: str,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None, flush_rows: int | None = None,
                 flush_seconds: int = K.SINK_FLUSH_SECONDS) -> DataFrame:
    """Broker source from the earliest offset; rows ``topic, key, value``.

    A trigger takes all offsets there are; ``max_offsets_per_trigger`` limits
    it where an operator asks for that.

    ``min_partitions`` splits large topic partitions into more Spark tasks
    (a topic with few partitions does not cap the decode parallelism).

    ``flush_rows``: a batch begins once that many rows wait, or
    ``flush_seconds`` after the last one, whichever is first; use it with a
    trigger that doesn't wait itself (``flush_seconds=0`` of the sink).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    if flush_rows:
        r = r.option("minOffsetsPerTrigger", flush_rows).option("maxTriggerDelay", f"{flush_seconds}s")
    return (r.load()
            .select(F.col("topic"), F.col("key").cast("string"), F.col("value").cast("string")))


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files of ``{topic, key, value}`` as a stream."""
    r = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def to_lake_rows(events: DataFrame, route: Route) -> DataFrame:
    """Events of one topic -> decoded lake rows with date partition columns."""
    df = events.filter(F.col("topic") == route.topic).select("value")
    if route.cdc:
        df = unwrap_cdc(df)
    rows = route.decoder(df)
    ts = F.col(route.time_col)
    return rows.select(*DECODERS[route.table][1].fieldNames(),
                       F.date_format(ts, "yyyy").alias("year"),
                       F.date_format(ts, "MM").alias("month"),
                       F.date_format(ts, "dd").alias("day"))


def start_ingest(events: DataFrame, lake_root: str, checkpoint_root: str,
                 selector: str | None = None, available_now: bool = False,
                 flush_seconds: int = K.SINK_FLUSH_SECONDS) -> list[StreamingQuery]:
    """Start one sink query per selected topic; returns the running queries."""
    queries = []
    for route in select_topics(selector):
        w = (to_lake_rows(events, route).writeStream
             .format("parquet")
             .outputMode("append")
             .partitionBy("year", "month", "day")
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{route.table}")
             .queryName(f"ingest_{route.table}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{flush_seconds} seconds")
        queries.append(w.start(f"{lake_root.rstrip('/')}/{route.table}"))
    return queries


def start_fanout(events: DataFrame, lake_root: str, checkpoint_root: str, selector: str | None = None,
                 available_now: bool = False, flush_seconds: int = K.SINK_FLUSH_SECONDS) -> StreamingQuery:
    """One query for all selected tables: each batch of the source is read
    once, kept while its tables are written, one after the other
    (``sources.lake_batches``). A batch that was interrupted is done again with
    the same rows under the same number: tables that have it whole are passed over,
    the others write over what the attempt before left.

    Several topics of a broker go in as the union of their sources."""
    routes = select_topics(selector)

    def write(batch: DataFrame, batch_id: int) -> None:
        left = [r for r in routes if not is_complete(batch.sparkSession, lake_root, r.table, batch_id)]
        if not left:
            return
        batch = batch.persist()
        try:
            for route in left:
                write_batch(to_lake_rows(batch, route), lake_root, route.table, batch_id)
        finally:
            batch.unpersist()

    w = (events.writeStream.foreachBatch(write).queryName("ingest_fanout")
         .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/fanout"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{flush_seconds} seconds")
    return w.start()
