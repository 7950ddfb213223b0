"""A crawl's queue and download log as streams, for inputs that keep coming.

The batch forms are in ``operators.crawl`` and ``operators.state``; these keep the same
results with state that Spark checkpoints.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators.dedup import content_hash
from corpusmill.operators.state import upsert


def unseen(pages: DataFrame, time: str, text: str = "text", within: str = "7 days") -> DataFrame:
    """The first row of each content hash; hashes are forgotten once the watermark has passed them."""
    return pages.withColumn("hash", content_hash(F.col(text))).withWatermark(time, within).dropDuplicatesWithinWatermark(["hash"])


def window_counts(pages: DataFrame, time: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows for each window and key; late rows count until the watermark passes the window."""
    return pages.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


class DownloadLog:
    """The download table kept up to date by a stream of batches.

    Each batch is merged into a new version of the table beside the old one, and a pointer file
    names the current version last, so a failed batch leaves the old one in use.
    """

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def read(self) -> DataFrame:
        try:
            name = self.spark.read.text(f"{self.path}/current").orderBy(F.desc("value")).first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            name = None
        if name is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{name['value'].split(' ')[1]}")

    def merge(self, batch: DataFrame, number: int, key: str = "cleaned_url", order: str = "download_time") -> None:
        version = f"v-{uuid.uuid4().hex}"
        upsert(self.read(), batch.withColumn("__at", F.col(order)), key, "__at").write.parquet(f"{self.path}/{version}")
        self.spark.createDataFrame([(f"{number:012d} {version}",)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/current")

    def follow(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
