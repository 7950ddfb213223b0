"""Word windows, token blocks and n-grams; native array expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.plans.prefix import running_total


#: Buckets whose sums are added up in one task.
REGION = 10_000


def words(text: Column) -> Column:
    """Runs of characters that are no Unicode white space."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\S+"), 0)


def window_starts(n: Column, size: int, overlap: int, backshift: bool = True) -> Column:
    """Where the windows of n words begin; with ``backshift`` the last is moved back to be full."""
    step = size - overlap
    if not backshift:
        return F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((n - F.lit(overlap)) / step).cast("int") - 1) * step, F.lit(step))).otherwise(F.array().cast("array<int>"))
    full = F.sequence(F.lit(0), F.floor((n - F.lit(size)) / step).cast("int") * step, F.lit(step))
    return F.when(n == 0, F.array().cast("array<int>")).when(n <= size, F.array(F.lit(0))).otherwise(F.array_union(full, F.array(n - F.lit(size))))


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 400, overlap: int = 50, backshift: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, chunk_index, start_word, end_word, chunk_words, chunk_text) and the kept columns."""
    rows = docs.select(key, *keep, words(F.col(text)).alias("w")).withColumn("n", F.size("w"))
    rows = rows.select(key, *keep, "w", "n", F.posexplode(window_starts(F.col("n"), size, overlap, backshift)).alias("chunk_index", "start_word"))
    rows = rows.withColumn("end_word", F.least(F.col("n"), F.col("start_word") + size))
    part = F.slice("w", F.col("start_word") + 1, F.col("end_word") - F.col("start_word"))
    return rows.select(key, *keep, "chunk_index", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("chunk_words"), F.array_join(part, " ").alias("chunk_text"))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of n neighbours, by joining shifted copies: the tokens are computed once, not once a gram."""
    many = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    out = F.slice(tokens, F.lit(1), many)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(tokens, F.lit(k + 1), many), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def token_blocks(docs: DataFrame, tokens: Column, key: str = "doc_id", block: int = 1024, end: str = "</s>", bucket: int = 1000) -> DataFrame:
    """(block_no, tokens): all documents' tokens in key order, an end token behind each, cut into
    full blocks; what is left at the end is dropped.

    A document's place is a running total over buckets of keys, so nothing is sorted in one
    task. Each document is sliced by the blocks it reaches, and a block gathers its
    slices, ``block`` tokens at most.
    """
    rows = docs.select(key, F.concat(tokens, F.array(F.lit(end))).alias("t"))
    rows = running_total(rows, F.floor(F.col(key) / bucket / REGION), F.floor(F.col(key) / bucket), [F.col(key)], F.size("t"), "at")
    reach = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.size("t") - 1) / block))
    rows = rows.withColumn("block_no", F.explode(reach))
    first = F.greatest(F.col("block_no") * block - F.col("at"), F.lit(0))
    last = F.least((F.col("block_no") + 1) * block - F.col("at"), F.size("t"))
    rows = rows.select("block_no", F.struct("at", F.slice("t", (first + 1).cast("int"), (last - first).cast("int")).alias("t")).alias("part"))
    full = rows.groupBy("block_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["t"])).alias("tokens"))
    return full.where(F.size("tokens") == block)
