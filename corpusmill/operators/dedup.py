"""Exact duplicates by content hash, and visited sets."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\x0b\f]+"


def content_hash(text: Column) -> Column:
    """SHA-256 of the bytes, stripped and lower-cased as bytes: ASCII letters and space only."""
    bare = F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")
    return F.sha2(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase), 256)


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The least ``order`` of each key and how many rows have it: an aggregate that is combined
    before its shuffle, so a key with most of the rows costs no task more than another."""
    return df.groupBy(*keys).agg(F.min(order).alias(order), F.count("*").alias("copies"))


def not_visited(urls: DataFrame, visited: DataFrame) -> DataFrame:
    return urls.distinct().join(visited, "url", "left_anti")
