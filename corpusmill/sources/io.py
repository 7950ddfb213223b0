"""Text, CSV, JSON and shard readers and writers, and a retrying fetch.

Paths are only given to Spark's readers and writers, so they may be in any store Spark knows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.training import chat_record, chat_rows, without_pipes

# Fixed value: encodings in the order in which they are tried; the last never fails.
ENCODINGS = ("utf-8", "utf-8-sig", "cp1252", "latin-1")


def decoded(raw: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 decodes anything")


@F.pandas_udf(T.StringType())
def decode(raw: pd.Series) -> pd.Series:
    return raw.map(decoded, na_action="ignore")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of all files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(path, text), each file whole, with the encoding fallback."""
    return files(spark, path, pattern).select("path", decode(F.col("content")).alias("text"))


def read_pipe_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.csv(path, sep="|", header=True).select(*columns)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records as one array or one to a line, told apart by the first character."""
    first = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.trim("value"), 1, 1).alias("c")).first()
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=bool(first and first["c"] == "["))


def read_records(spark: SparkSession, path: str, content_type: str | None, schema: str | None = None) -> DataFrame:
    """Records by the content type they came with: lines of one record each, else each file as one JSON value."""
    lines = any(kind in (content_type or "").lower() for kind in ("ndjson", "jsonl"))
    return (spark.read.schema(schema) if schema else spark.read).json(path, multiLine=not lines)


def write_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def write_pipe_csv(rows: DataFrame, path: str) -> None:
    without_pipes(rows).write.mode("overwrite").csv(path, sep="|", header=True)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_chat_jsonl(pairs: DataFrame, path: str, max_answer: int | None = None) -> None:
    """One chat record to a line, with both messages and the flat text."""
    rows = chat_rows(pairs, max_answer).select(chat_record(F.col("question"), F.col("answer")).alias("r"))
    rows.select("r.*").write.mode("overwrite").json(path)


def write_shards(rows: DataFrame, path: str, cluster: str = "cluster_id") -> DataFrame:
    """A folder for each cluster, so that routed reads prune the rest; returns each shard's size.

    Rows are rebalanced by cluster, which splits a cluster that holds most of them into several files.
    """
    rows.hint("rebalance", cluster).write.mode("overwrite").partitionBy(cluster).parquet(path)
    return rows.groupBy(cluster).agg(F.count("*").alias("size"))


def write_index(packed: DataFrame, path: str) -> None:
    """The packed index, a line for each term in term order of its files."""
    packed.orderBy("term").write.mode("overwrite").json(path)


FETCHED = "url string, status int, content_type string, body binary, error string"


def fetch(urls: DataFrame, get: Callable[[str], tuple[int, str, bytes]], tries: int = 3, pause: float = 1.5) -> DataFrame:
    """(url, status, content_type, body, error) of each url, fetched where its row is.

    ``get`` returns (status, content type, body). Errors and status 429 are tried again, after
    a pause that grows by ``pause`` each time; the last error is kept in the row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url in batch["url"]:
                row = (url, 500, "text/html", b"", "not tried")
                for attempt in range(1, tries + 1):
                    try:
                        status, kind, body = get(url)
                        row = (url, status, kind, body, None)
                        if status != 429:
                            break
                    except Exception as e:  # any failure of a remote site is a row's error
                        row = (url, 500, "text/html", b"", str(e))
                    if attempt < tries:
                        time.sleep(pause * attempt)
                rows.append(row)
            yield pd.DataFrame(rows, columns=["url", "status", "content_type", "body", "error"])

    return urls.select("url").mapInPandas(run, FETCHED)
