"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a record's language are combined as log odds:

* the text: naive Bayes over byte trigrams, trained on a bounded sample of documents with a
  known language; its weight is tempered to ``TEXT_TRIGRAMS`` trigrams, so that a long
  text does not outvote everything else merely by its length;
* the language that the markup declares (``<html lang=..>``);
* the address suffix (the host's last label, if it isn't a number);
* the host: a prior smoothed hierarchically, host towards domain towards all records.

The last three are estimated from all other records by grouped aggregation of their texts'
posteriors, each shrunk by ``STRENGTH`` records towards the level above; a record's own
posterior is taken out of its groups' sums again, so that its text counts once. The aggregates
are combined before their shuffle, so a host with a third of all records is a
few partial rows; records meet their host's row in a join that may be split.

Every label of the documents is learned. The model has ``BUCKETS`` float32 numbers for each (256 kB), so
memory grows with the labels.

Records are pages (url and html) and documents (text and source, which has the host's part).

Defined results: missing evidence (null or empty text, no declaration, no url) is no
evidence; a record without any gets the overall prior. Ties go to the language first
in order. Every row is returned, repeated rows too; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.kernels import LOWER, arrow_limits, byte_table, text_slices
from corpusmill.llm.url_filter import url_host
from corpusmill.plans.lineage import cut

#: Training documents of each language, the first in hash order.
MAX_TRAINING = 400
BUCKETS = 1 << 16
TEXT_TRIGRAMS = 40
STRENGTH = 5.0
#: Bytes that are no letters count as a space; digits and marks say little about a language.
PLAIN = np.where(byte_table([b for b in range(0x80) if not chr(b).isalpha()]), 0x20, LOWER).astype(np.uint8)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of the byte trigrams with at most one space, within each text."""
    plain = PLAIN[data]
    n = len(plain) - 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = plain.astype(np.uint32)
    bucket = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B) + x[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(16)
    space = (plain == 0x20).astype(np.uint8)
    good = space[:-2] + space[1:-1] + space[2:] <= 1
    inner = offsets[1:-1]
    for back in (1, 2):
        at = inner - back
        good[at[(at >= 0) & (at < n)]] = False
    at = np.flatnonzero(good)
    return np.searchsorted(offsets, at, "right") - 1, bucket[at].astype(np.int64)


def train(docs: DataFrame, label: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log likelihood of each bucket in each of them."""
    spark = docs.sparkSession
    arrow_limits(spark)
    docs = docs.select("doc_id", "text", F.col(label).alias(label))
    known = docs.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.col(label).alias("l"))
    names = sorted(r["l"] for r in known.select("l").distinct().collect())
    if not names:
        return ["und"], np.zeros((BUCKETS, 1), np.float32)
    # each task keeps the first of a label before they are dealt, so a common label is no large group
    first = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("id"), "id"))
    chosen = known.withColumn("n", first).where(F.col("n") <= MAX_TRAINING)
    chosen = chosen.join(F.broadcast(spark.createDataFrame(list(enumerate(names)), "k int, l string")), "l").select("id", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = batch.column(0).to_numpy()
            for i, j, data, offsets in text_slices(batch):
                of, bucket = trigrams(data, offsets)
                for k in np.unique(lang[i:j]):
                    total[k] = total.get(k, 0) + np.bincount(bucket[lang[i:j][of] == k], minlength=BUCKETS)
        for k, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))], names=["k", "b", "n"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("k", "text")
    rows = texts.mapInArrow(run, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(names), BUCKETS))
    counts[rows["k"].to_numpy(), rows["b"].to_numpy()] = rows["n"].to_numpy()
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    return names, np.log(share).T.astype(np.float32).copy()


def text_scores(records: DataFrame, table: np.ndarray) -> DataFrame:
    """(id columns.., text log likelihoods): the mean over trigrams times at most ``TEXT_TRIGRAMS``."""
    arrow_limits(records.sparkSession)
    kept = [c for c in records.columns if c not in ("text", "markup")]
    model = table - table.mean(axis=1, keepdims=True)

    def visible(data: np.ndarray, offsets: np.ndarray, markup: np.ndarray) -> np.ndarray:
        """Markup blanked: what stands between < and > of records with markup."""
        inside = np.repeat(markup, np.diff(offsets))
        opens, closes = np.cumsum((data == 0x3C) & inside), np.cumsum((data == 0x3E) & inside)
        base = np.repeat((opens - closes)[np.maximum(offsets[:-1] - 1, 0)] * (offsets[:-1] > 0), np.diff(offsets)) if len(data) else 0
        return np.where((opens - closes - base > 0) | ((data == 0x3E) & inside), np.uint8(0x20), data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, markup = len(kept), len(kept) + 1
        step = max(1, (1 << 24) // model.shape[1])  # trigrams at a time
        for batch in batches:
            rows = []
            marks = batch.column(markup).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_slices(batch, "text"):
                of, bucket = trigrams(visible(data, offsets, marks[i:j]) if marks[i:j].any() else data, offsets)
                n = np.bincount(of, minlength=j - i)
                z = np.zeros((j - i, model.shape[1]))
                for a in range(0, len(of), step):
                    first = np.flatnonzero(np.diff(of[a : a + step], prepend=-1))
                    z[of[a + first]] += np.add.reduceat(model[bucket[a : a + step]], first, axis=0)
                rows.append(z * (np.minimum(n, TEXT_TRIGRAMS) / np.maximum(n, 1))[:, None])
            z = np.concatenate(rows) if rows else np.zeros((0, model.shape[1]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(text)], lists], names=[*kept, "z"])

    fields = ", ".join(f"`{c}` {t}" for c, t in records.dtypes if c in kept)
    return records.select(*kept, "text", "markup").mapInArrow(run, f"{fields}, z array<double>")


def posterior(z: Column) -> Column:
    top = F.array_max(z)
    odds = F.transform(z, lambda x: F.exp(x - top))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, y: a + y))


def _sums(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Per group, the posteriors added up by language."""
    return df.groupBy(*keys).agg(F.array(*[F.sum(F.element_at("p", k + 1)) for k in range(n)]).alias("s"))


def _shrunk(s: Column, parent: Column, own: Column) -> Column:
    """Shares by language without the record's ``own`` posterior, drawn towards the level above by ``STRENGTH`` records."""
    others = F.zip_with(s, own, lambda x, p: F.greatest(x - p, F.lit(0.0)))
    total = F.aggregate(others, F.lit(0.0), lambda a, y: a + y)
    return F.zip_with(others, parent, lambda x, q: (x + STRENGTH * q) / (total + STRENGTH))


def fuse(scored: DataFrame, names: list[str]) -> DataFrame:
    """Posterior of each record from its text, declaration, suffix and host."""
    n = len(names)
    records = scored.withColumn("p", posterior(F.col("z")))
    overall = _sums(records, [], n).first()
    sums = F.array(*[F.lit(float(x or 0.0)) for x in (overall["s"] if overall else [0.0] * n)])
    flat = F.array(*[F.lit(1.0 / n)] * n)
    hosts = cut(_sums(records.where("host IS NOT NULL"), ["domain", "host"], n))
    domains = _sums(hosts.select("domain", F.col("s").alias("p")), ["domain"], n).select("domain", F.col("s").alias("domain_sums"))
    hosts = hosts.join(domains, "domain").select(F.col("host").alias("h"), F.col("domain").alias("d"), F.col("s").alias("host_sums"), "domain_sums")
    out = records.withColumn("base", _shrunk(sums, flat, F.col("p")))
    out = out.join(hosts, F.col("host").eqNullSafe(F.col("h")) & F.col("domain").eqNullSafe(F.col("d")), "left")
    prior = F.when(F.col("h").isNull(), F.col("base")).otherwise(_shrunk(F.col("host_sums"), _shrunk(F.col("domain_sums"), F.col("base"), F.col("p")), F.col("p")))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    z = add(F.col("z"), F.transform(prior, lambda x: F.log(x)))
    for column in ("declared", "suffix"):
        # how much likelier each language is with this value than overall
        groups = _sums(records.where(F.col(column).isNotNull()), [column], n).select(F.col(column).alias(f"{column}_of"), F.col("s").alias(f"{column}_sums"))
        out = out.join(groups, F.col(column) == F.col(f"{column}_of"), "left")
        odds = F.zip_with(_shrunk(F.col(f"{column}_sums"), F.col("base"), F.col("p")), F.col("base"), lambda x, q: F.log(x / q))
        z = F.when(F.col(f"{column}_of").isNull(), z).otherwise(add(z, odds))
    out = out.withColumn("post", posterior(z))
    best = F.array_position("post", F.array_max("post")).cast("int")
    return out.withColumn("predicted", F.element_at(F.array(*[F.lit(x) for x in names]), best)).withColumn("confidence", F.array_max("post"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(kind, page_id, doc_id, declared, predicted, confidence) of every page and document."""
    # the name alone: neither a user before @ nor a port
    host = F.nullif(F.regexp_replace(url_host(F.col("url")), r"^.*@|:\d*$", ""), F.lit(""))
    plain = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    from_pages = pages.select(
        F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("long").alias("doc_id"), host.alias("host"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit("")).alias("declared"), plain.alias("text"), F.lit(True).alias("markup"),
    )
    from_pages = from_pages.withColumn("suffix", F.nullif(F.regexp_extract("host", r"(?:^|\.)([^.]*[^.\d][^.]*)$", 1), F.lit(""))).withColumn("domain", F.array_join(F.slice(F.concat(F.array(F.lit("")), F.split("host", r"\.")), -2, 2), "."))
    from_docs = docs.select(F.lit("document").alias("kind"), F.lit(None).cast("long").alias("page_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("host"), F.lit(None).cast("string").alias("declared"), F.col("text"), F.lit(False).alias("markup"))
    from_docs = from_docs.withColumn("suffix", F.lit(None).cast("string")).withColumn("domain", F.when(F.col("host").isNotNull(), F.lit("documents")))
    names, table = train(docs)
    scored = cut(text_scores(from_pages.unionByName(from_docs), table))
    return fuse(scored, names).select("kind", "page_id", "doc_id", "declared", "predicted", "confidence")


def op8_language(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
