"""Daily card-movement CSV drops.

Files are ``<root>/<YYYY-MM-DD>/movimientos.csv`` with a header row and five
columns taken by position. A line with more or fewer fields, or a field that
does not fit its type, fails the load. The literal text ``None`` is a NULL
marker; ``source_date`` is the name of the file's folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewatch.sources.schemas import MONEY

LANDING_FILE = "movimientos.csv"
_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in
                      ("card_id", "date", "amount", "merchant_category", "location")])
_SOURCE_DATE = r"/([^/]+)/movimientos\.csv$"


LANDING_ROWS = T.StructType([
    T.StructField("card_id", T.LongType()), T.StructField("date", T.TimestampNTZType()),
    T.StructField("amount", MONEY), T.StructField("merchant_category", T.StringType()),
    T.StructField("location", T.StringType()), T.StructField("source_date", T.StringType())])


def _none_to_null(c: str):
    return F.nullif(F.col(c), F.lit("None"))


def scan_landing_csv(spark: SparkSession, root: str) -> DataFrame:
    try:
        raw = (spark.read.option("header", True)
               .option("recursiveFileLookup", True)
               .option("pathGlobFilter", LANDING_FILE)
               .option("enforceSchema", True)
               .option("mode", "FAILFAST")  # a line with more or fewer fields fails the load
               .schema(_TEXT)
               .csv(root))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], LANDING_ROWS)
    return raw.select(
        _none_to_null("card_id").cast("long").alias("card_id"),
        _none_to_null("date").cast("timestamp_ntz").alias("date"),
        _none_to_null("amount").cast(MONEY).alias("amount"),
        _none_to_null("merchant_category").alias("merchant_category"),
        _none_to_null("location").alias("location"),
        F.regexp_extract(F.col("_metadata.file_path"), _SOURCE_DATE, 1).alias("source_date"),
    )
