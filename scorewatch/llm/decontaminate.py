"""Benchmark decontamination by size-partitioned MinHash containment, DataFrame
operations only.

Items (short) and documents (of any length) are sets of five-word shingles. A
document is contaminated by an item if it holds at least ``least`` of the
item's distinct shingles. The bottom-k MinHash sketch of an item is the k
shingle hashes that come first in hash order. Items are partitioned by size
class (powers of two): a class whose largest item has u shingles tolerates
floor((1 - least) * u) missing ones, and its sketches are ``spare`` longer than
that. So a document that holds enough of an item holds ``spare`` hashes of its
sketch at least, however long it is: the search loses nothing. Candidates are
verified by the exact share of shingle strings.

Items of equal text are one item for the search, so their documents are verified
once; their ids come back at the end. Only sketch hashes meet the documents'
shingles. The sketch table and the items' shingle strings each go to every executor
if they have at most ``max_broadcast`` bytes (added up first); larger ones are
joined by shuffle.

Defined cases: words are runs of letters and digits, lower-cased; null or
empty texts and those under five words have no shingles and no match; repeated
items and documents match like single ones, once per id and text; null ids
are kept in the result; empty tables give an empty result; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, texts

WORDS = 5
LEAST = 0.8


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(w: str, of) -> Column:
    """``of`` each five consecutive words of the array column ``w``."""
    size = F.size(w)
    return F.when(size >= WORDS, F.transform(
        F.sequence(F.lit(1), F.greatest(size - (WORDS - 1), F.lit(1))), lambda i: of(F.slice(w, i, WORDS)))
    ).otherwise(F.array().cast("array<bigint>" if of is F.xxhash64 else "array<string>"))


def _text(shingle: Column) -> Column:
    return F.array_join(shingle, " ")


def item_sketches(items: DataFrame, least: float, spare: int) -> DataFrame:
    """item, strings (its distinct shingles), size, sketch, need (hits that a
    document with enough of the item must have)."""
    sized = (items.withColumn("w", words(F.col("text")))
             .select("item", F.array_distinct(shingles("w", _text)).alias("strings"),
                     F.array_sort(F.array_distinct(shingles("w", F.xxhash64))).alias("hashes"))
             .withColumn("size", F.size("hashes")).filter("size > 0")
             .withColumn("class", F.floor(F.log2("size")).cast("int")))
    classes = sized.groupBy("class").agg(F.floor(F.max("size") * F.lit(round(1 - least, 9)) + 1e-6).cast("int").alias("missing"))
    tolerated = F.floor(F.col("size") * F.lit(round(1 - least, 9)) + 1e-6).cast("int")
    return (sized.join(classes, "class")
            .withColumn("sketch", F.slice("hashes", F.lit(1), F.col("missing") + spare))
            .withColumn("need", F.greatest(F.size("sketch") - tolerated, F.lit(1)))
            .select("item", "strings", "size", "sketch", "need"))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, spare: int = 2,
                 max_broadcast: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_found, containment: every
    pair of a document and an item that it holds, and ``hash`` of the text."""
    source = texts(docs, id_col, text_col).withColumn("d", F.struct("doc_id", F.xxhash64("text").alias("hash")))
    ids = texts(benchmark, item_id_col, item_text_col).distinct().select(
        F.col("doc_id").alias("item_id"), F.sha2(F.col("text").cast("binary"), 256).alias("item"), "text")
    items = ids.groupBy("item").agg(F.first("text").alias("text"))
    sketches = checkpointed(item_sketches(items, least, spare))
    probe = sketches.select("item", "need", F.explode("sketch").alias("h"))
    key = 64 + 16  # bytes of an item's digest and of what stands beside it
    sizes = sketches.agg(
        F.sum((F.lit(key) + 8) * F.size("sketch")).alias("probe"),
        F.sum(key + F.aggregate("strings", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 16)).alias("strings")).first()

    def sent(df: DataFrame, size: int | None) -> DataFrame:
        return F.broadcast(df) if (size or 0) <= max_broadcast else df

    occurring = source.withColumn("w", words(F.col("text"))).select("d", F.explode(shingles("w", F.xxhash64)).alias("h"))
    candidates = (occurring.join(sent(probe, sizes.probe), "h").groupBy("d", "item").agg(
        F.countDistinct("h").alias("hits"), F.first("need").alias("need")).filter("hits >= need").select("d", "item"))
    held = candidates.join(sent(sketches.select("item", "strings"), sizes.strings), "item").groupBy("d").agg(
        F.collect_list(F.struct("item", "strings")).alias("asked"))
    # d may hold a null id
    pairs = (held.withColumnRenamed("d", "d2").join(source.select("d", "text"), F.col("d2").eqNullSafe(F.col("d")))
             .withColumn("w", words(F.col("text"))).withColumn("s", F.array_distinct(shingles("w", _text)))
             .select("d", F.explode(F.transform("asked", lambda a: F.struct(
                 a["item"].alias("item"), F.size(a["strings"]).alias("n_shingles"),
                 F.size(F.array_intersect(a["strings"], F.col("s"))).alias("n_found")))).alias("p"))
             .filter(F.col("p.n_found") >= F.col("p.n_shingles") * least - 1e-9).distinct())
    named = pairs.withColumn("item", F.col("p.item")).join(ids.select("item", "item_id"), "item")
    return named.select(F.col("d.doc_id").alias("doc_id"), "item_id",
                        F.col("p.n_shingles").cast("int").alias("n_shingles"), F.col("p.n_found").cast("int").alias("n_found"),
                        (F.col("p.n_found") / F.col("p.n_shingles")).alias("containment"), F.col("d.hash").alias("hash"))


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text",
          **limits) -> DataFrame:
    """``docs`` with its columns, without the contaminated documents."""
    bad = (contaminated(docs, benchmark, least, id_col=id_col, text_col=text_col, **limits)
           .select(F.struct("doc_id", "hash").alias("_bad")).distinct())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumn("_d", F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash")))
    return marked.join(bad, F.col("_d").eqNullSafe(F.col("_bad")), "left_anti").select(*docs.columns)
