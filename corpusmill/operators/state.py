"""Cache state: upserts, validated lookups and removals as DataFrame merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOWNLOADS = T.StructType([T.StructField("cleaned_url", T.StringType()), T.StructField("content_type", T.StringType()), T.StructField("url_file_path", T.StringType()), T.StructField("url_file_size", T.LongType()), T.StructField("text_file_path", T.StringType()), T.StructField("text_file_size", T.LongType()), T.StructField("hash", T.StringType()), T.StructField("download_time", T.TimestampType())])
QUEUE = T.StructType([T.StructField("url", T.StringType()), T.StructField("depth_actual", T.IntegerType()), T.StructField("depth_effective", T.IntegerType())])


def empty(spark, schema: T.StructType) -> DataFrame:
    """A table that doesn't exist yet, or that was cleared."""
    return spark.createDataFrame([], schema)


def upsert(state: DataFrame, batch: DataFrame, key: str, order: str, frozen: tuple[str, ...] = ("content_type",)) -> DataFrame:
    """``state`` after the batch's rows in ``order``: the last row of a key wins, but frozen
    columns keep the value of the key's first row."""
    values = [c for c in state.columns if c != key]
    old = state.withColumn(order, F.lit(None).cast(batch.schema[order].dataType)).withColumn("__new", F.lit(0))
    rows = old.unionByName(batch.select(*state.columns, order).withColumn("__new", F.lit(1)))
    at = F.struct("__new", order)
    pick = lambda c: (F.min_by if c in frozen else F.max_by)(F.col(c), at).alias(c)
    return rows.groupBy(key).agg(*[pick(c) for c in values]).select(*state.columns)


def validated(state: DataFrame, listing: DataFrame) -> DataFrame:
    """(cleaned_url, status): hit where the file exists at the recorded size, else stale or missing."""
    found = state.join(listing.select(F.col("path").alias("url_file_path"), F.col("size").alias("__size")), "url_file_path", "left")
    status = F.when(F.col("__size").isNull(), "missing").when(F.col("__size") == F.col("url_file_size"), "hit").otherwise("stale")
    return found.select("cleaned_url", status.alias("status"))


def file_info(state: DataFrame, listing: DataFrame) -> DataFrame:
    """(url_file_path, url_file_size, text_file_path, text_file_size) of the rows whose two files exist at their recorded sizes."""
    rows = state.select("url_file_path", "url_file_size", "text_file_path", "text_file_size")
    for c in ("url", "text"):
        rows = rows.join(listing.select(F.col("path").alias(f"{c}_file_path"), F.col("size").alias(f"{c}_file_size")).distinct(), [f"{c}_file_path", f"{c}_file_size"], "left_semi")
    return rows


def remove(state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return state.join(keys.select(key).distinct(), key, "left_anti").select(*state.columns)
