"""Tokenisers, term counts, both TF-IDF weightings and the inverted index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.chunk import ngrams
from corpusmill.plans.lineage import cut
from corpusmill.plans.prefix import running_total

# The stop words of the index.
STOP = (
    "a an and are as at be but by for from has have in into is it its of on or over such that the their then there these this to was "
    "were will with without i you he she they we them his her our your my mine ours yours theirs not no yes do did done what when where "
    "who why how which"
).split()
FIELDS = {"chunk_text": 1.0, "title": 2.0, "section": 1.0}


def _kept(tokens: Column, stop: Sequence[str], least: int = 2) -> Column:
    return F.filter(tokens, lambda t: (F.length(t) >= least) & ~t.isin(*stop)) if stop else F.filter(tokens, lambda t: F.length(t) >= least)


def index_tokens(text: Column, stop: Sequence[str] = STOP) -> Column:
    """ASCII letter and digit runs, lower-cased, of two or more, without stop words."""
    return _kept(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z0-9]+"), 0), F.lower), stop)


def query_tokens(text: Column, stop: Sequence[str] = STOP) -> Column:
    """Words with inner apostrophes and hyphens; no digits."""
    return _kept(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z][a-z'-]{1,}"), 0), stop)


def name_tokens(text: Column, stop: Sequence[str] = STOP) -> Column:
    """As for phrase counts: letters first, then letters, apostrophes and hyphens, lower-cased."""
    return _kept(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z][A-Za-z'-]{1,}"), 0), F.lower), stop)


def unicode_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), 0)


def row_counts(docs: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, tf) of each row's (term, w) structs: the weights of equal terms summed.

    A document is a row, so its tokens are sorted and added up in its own array; nothing is shuffled. The outer
    explode keeps the optimizer from computing the array once more for a filter on its size.
    """
    rows = docs.select(key, F.sort_array(tokens).alias("s"))
    n = F.size("s")
    last = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get("s", i - 1)["term"] != F.get("s", i)["term"]))
    rows = rows.select(key, "s", F.when(n > 0, last).alias("e"))

    def run(e: Column, k: Column) -> Column:
        begin = F.when(k == 0, F.lit(0)).otherwise(F.get("e", k - 1))
        total = F.aggregate(F.slice("s", begin + 1, e - begin), F.lit(0.0), lambda a, t: a + t["w"])
        return F.struct(F.get("s", e - 1)["term"].alias("term"), total.alias("tf"))

    return rows.select(key, F.explode_outer(F.transform("e", run)).alias("t")).select(key, "t.term", "t.tf").where("term IS NOT NULL")


def weighed(tokens: Column, weight: float) -> Column:
    return F.transform(tokens, lambda t: F.struct(t.alias("term"), F.lit(weight).alias("w")))


def term_frequencies(docs: DataFrame, key: str, fields: dict[str, float], tokens=index_tokens) -> DataFrame:
    """(key, term, tf): field weights summed over all places of a term; each row is a document."""
    return row_counts(docs, key, F.concat(*[weighed(tokens(F.col(c)), float(w)) for c, w in fields.items()]))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """One row for each document and term has been made, so a count is enough."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def idf(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def normalised(rows: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """Weights over each document's length, a window over the terms of one document."""
    norm = F.sqrt(F.sum(F.col(raw) * F.col(raw)).over(Window.partitionBy(key)))
    return rows.withColumn("weight", F.col(raw) / norm).drop(raw)


def weights(docs: DataFrame, key: str = "doc_id", fields: dict[str, float] | None = None, tokens=index_tokens) -> DataFrame:
    """(key, term, df, weight): (1 + ln tf) * idf, normalised."""
    tf = cut(term_frequencies(docs, key, fields or FIELDS, tokens))  # read for the frequencies and for the weights
    n = docs.agg(F.count("*").alias("n"))
    rows = tf.join(document_frequencies(tf), "term").join(F.broadcast(n))
    rows = rows.withColumn("raw", (1 + F.log("tf")) * idf(F.col("df"), F.col("n"))).where("raw > 0").select(key, "term", "df", "raw")
    return normalised(rows, key)


def vectorise(docs: DataFrame, text: Column, key: str = "doc_id", stop: Sequence[str] = (), n_max: int = 2, max_df: float = 0.9, min_df: int = 2) -> DataFrame:
    """(key, term, weight) of raw counts of 1- to n-grams over the words left by the stop list,
    pruned by document frequency, times ln((1 + N) / (1 + df)) + 1, normalised."""
    words = F.filter(unicode_words(text), lambda t: ~t.isin(*stop)) if stop else unicode_words(text)
    base = docs.select(key, words.alias("w"))
    tf = cut(row_counts(base, key, weighed(F.concat(*[ngrams(F.col("w"), k) for k in range(1, n_max + 1)]), 1.0)))
    n = docs.agg(F.count("*").alias("n"))
    kept = document_frequencies(tf).join(F.broadcast(n)).where((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("n")))
    rows = tf.join(kept, "term").select(key, "term", (F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("raw"))
    return normalised(rows, key)


def vocabulary(terms: DataFrame) -> DataFrame:
    """(term, idx, offset): places in term order, and where each term's postings begin. Ranks come from
    bucketed running totals over the terms' first two letters, not from one sorted task."""
    region, bucket = F.substring("term", 1, 1), F.substring("term", 1, 2)
    rows = running_total(terms.select("term", "df"), region, bucket, [F.col("term")], F.lit(1), "idx")
    return running_total(rows, region, bucket, [F.col("term")], F.col("df"), "offset").select("term", "df", "idx", "offset")


def packed(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per term in the packed layout: its place, offset, documents and weights."""
    lists = index.groupBy("term").agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("id"), "weight"))).alias("p"), F.count("*").alias("df"))
    return lists.join(vocabulary(lists.select("term", "df")).drop("df"), "term").select("term", "idx", "offset", F.transform("p", lambda p: p["id"]).alias("doc_ids"), F.transform("p", lambda p: p["weight"]).alias("weights"))


def unpack(packed_: DataFrame, key: str = "doc_id") -> DataFrame:
    pairs = packed_.select("term", F.explode(F.arrays_zip("doc_ids", "weights")).alias("p"))
    return pairs.select("term", F.col("p.doc_ids").alias(key), F.col("p.weights").alias("weight"))


def top_terms(docs: DataFrame, tokens: Column, n: int = 1, k: int = 100) -> DataFrame:
    """The k most frequent n-grams over the filtered tokens, ties in term order."""
    return docs.select(F.explode_outer(ngrams(tokens, n)).alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)
