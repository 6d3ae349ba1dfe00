"""Corpus pipeline: from raw documents to token ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.

1. toxicity: documents that the positive-unlabelled model rejects go.
2. line_dedup: later copies of line runs of 50 words or more go; a document
   of which nothing is left goes too.
3. near_dedup: one document of each class of near duplicates stays.
4. decontamination: documents that hold a benchmark item go.
5. bpe: token ids of what is left, with a check of the round trip.

Every stage takes null ids and texts, empty and very long texts, repeated rows
(near_dedup keeps rows equal in id and text together) and an empty table, and hands on
every column of its input, whatever its name; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.llm import bpe, decontaminate, line_dedup, near_dup, toxicity_pu
from scorewatch.llm.common import fold, read_table, shared_folder, shipped, texts
from scorewatch.llm.queries import MULTI_RANKS


@shipped
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_pu.fit(texts(docs), read_table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity_pu.kept(docs, model)


@shipped
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


@shipped
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens and
    decoded_sha256, the digest of the bytes that the ids decode to."""
    path = public_tokenizers.path(MULTI_RANKS)
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    return decoded.select("doc_id", "ids", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: Learnt scores, sketches and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
