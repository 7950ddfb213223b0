"""Toxicity by non-negative positive-unlabelled learning.

Some texts are confirmed toxic, the rest are unlabelled. A linear classifier with
logistic loss is trained in numpy on the non-negative PU risk (Kiryo et al., 2017)

    pi * E_p[l(z)] + max(0, E_u[l(-z)] - pi * E_p[l(-z)])

whose correction by the class prior ``pi`` removes the toxic texts hidden among the
unlabelled ones from their loss. When the second term is negative a step is taken
against it alone, so the risk can't be driven below zero by overfitting.

Features are hashes of lower-cased words and of their first 4, 5 and 6 bytes, each
as present once, twice and four times or more. Training reads two bounded samples, the first ``MAX_POSITIVE`` confirmed
and ``MAX_UNLABELLED`` any documents in hash order, one text of each id, and of a text at most
``TEXT_FEATURES`` features; the prior counts all labels of the training folds. Scoring is one pass over all whole texts with a model of ``MAX_FEATURES``
weights and moves no data between tasks.

Defined results: labels.toxic alone is learned from, in folds other than the held-out one; a
document labelled more than once counts as toxic if any label says so; null labels
don't count. Null and empty texts get the bias's score. Without any confirmed
document all scores are the prior's. Repeated rows are kept; other columns are
carried through by ``with_scores``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.kernels import LOWER, SPACE, U64, arrow_limits, byte_table, mixed, span_hashes, spans, text_slices
from corpusmill.plans.lineage import spread

MAX_POSITIVE = 2000
MAX_UNLABELLED = 4000
MAX_FEATURES = 1500
#: Features of one sampled text, the first in hash order; so what the driver gathers has a bound whatever the texts' length.
TEXT_FEATURES = 8192
MIN_COUNT = 4
#: Standard errors by which a feature must be commoner in confirmed texts than in unlabelled ones.
MIN_LIFT = 6.0
PREFIXES = (4, 5, 6)
LEVELS = (1, 2, 4)
STEPS = 400
RATE = 0.05
RIDGE = 1e-4
THRESHOLD = 0.7
#: Words are runs of bytes that are neither white space nor ASCII punctuation.
OUTSIDE = SPACE | byte_table([b for b in range(0x80) if not chr(b).isalnum()])


def fold(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and word beginning."""
    with np.errstate(over="ignore"):
        data = LOWER[data]
        starts, ends, first = spans(data, offsets, OUTSIDE)
        of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        where, hashes = [of], [span_hashes(data, starts, ends)]
        for n in PREFIXES:
            long = np.flatnonzero(ends - starts > n)
            where.append(of[long])
            hashes.append(mixed(span_hashes(data, starts[long], starts[long] + n) + U64(n)))
        return np.concatenate(where), np.concatenate(hashes)


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes
    weights: np.ndarray  # a row for each key, a column for each level of its count
    bias: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys & U64((1 << 20) - 1)).astype(np.int64)] = True

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        where, hashes = features(data, offsets)
        hit = np.flatnonzero(self.maybe[(hashes & U64((1 << 20) - 1)).astype(np.int64)])
        z = np.full(len(offsets) - 1, self.bias)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes[hit]), len(self.keys) - 1)
            same = self.keys[at] == hashes[hit]
            found, count = np.unique(where[hit][same] * len(self.keys) + at[same], return_counts=True)
            for k, level in enumerate(LEVELS):
                some = found[count >= level]
                np.add.at(z, some // len(self.keys), self.weights[some % len(self.keys), k])
        return sigmoid(z)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the PU risk with logistic loss: of positives, and of negatives before it is kept from falling below 0."""
    return prior * float(np.logaddexp(0, -zp).mean()), float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())


def gradient(x_p: np.ndarray, x_u: np.ndarray, zp: np.ndarray, zu: np.ndarray, prior: float) -> np.ndarray:
    """Of the non-negative risk by weights and bias; where its second term is below 0, against that term alone."""

    def pull(x, z, sign):
        """Gradient of the mean of l(sign * z)."""
        g = (-sign * sigmoid(-sign * z) / len(x)).astype(np.float32)
        return np.append(g @ x, g.sum()).astype(np.float32)

    negative = pull(x_u, zu, -1) - prior * pull(x_p, zp, -1)
    return prior * pull(x_p, zp, 1) + negative if risk(zp, zu, prior)[1] >= 0 else -negative


def nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier with least non-negative PU risk (Adam, full batches)."""
    w = np.zeros(positive.shape[1] + 1, np.float32)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = positive @ w[:-1] + w[-1], unlabelled @ w[:-1] + w[-1]
        grad = gradient(positive, unlabelled, zp, zu, prior)
        grad[:-1] += RIDGE * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1].astype(np.float64), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1) -> Model:
    """Train on the folds other than ``held_out``."""
    spark = docs.sparkSession
    arrow_limits(spark)
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != held_out))
    marks = marks.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    count = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    prior = min(max((count["p"] or 0) / max(count["n"], 1), 1e-3), 0.5)
    in_order = F.xxhash64("doc_id")
    some = marks.where("toxic = 1").orderBy(in_order, "doc_id").limit(MAX_POSITIVE).select("doc_id", F.lit(1).alias("p"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != held_out))
    ids = ids.orderBy(in_order, "doc_id").limit(MAX_UNLABELLED)
    chosen = some.unionByName(ids.select("doc_id", F.lit(0).alias("p"))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch):
                where, hashes = features(data, offsets)
                order = np.lexsort((hashes, where))
                where, hashes = where[order], hashes[order]
                new = np.ones(len(where), bool)
                new[1:] = (where[1:] != where[:-1]) | (hashes[1:] != hashes[:-1])
                count = np.minimum(np.diff(np.append(np.flatnonzero(new), len(where))), LEVELS[-1]).astype(np.int8)
                where, hashes = where[new], hashes[new]
                few = np.arange(len(where)) - np.searchsorted(where, where) < TEXT_FEATURES
                where, hashes, count = where[few], hashes[few], count[few]
                at = np.searchsorted(where, np.arange(j - i + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (hashes.view(np.int64), count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *lists], names=["p", "f", "c"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "p").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("p", "text")
    rows = texts.mapInArrow(run, "p int, f array<long>, c array<byte>").toArrow()
    flags = rows["p"].to_numpy().astype(bool)
    flat = lambda name: pa.chunked_array([c.flatten() for c in rows[name].chunks], rows[name].type.value_type).to_numpy()
    hashes, count = flat("f").view(U64), flat("c")
    sizes = [c.value_lengths().to_numpy() for c in rows["f"].chunks]
    where = np.repeat(np.arange(len(flags), dtype=np.int32), np.concatenate(sizes) if sizes else np.zeros(0, int))
    del rows
    n_p, n_u = int(flags.sum()), int((~flags).sum())
    if not n_p or not n_u:
        return Model(np.zeros(0, U64), np.zeros((0, len(LEVELS))), float(np.log(prior / (1 - prior))))
    # only features of enough confirmed texts can be chosen, a small part of all
    keys, times = np.unique(hashes[flags[where]], return_counts=True)
    keys = keys[times >= MIN_COUNT]
    if not len(keys):
        return Model(keys, np.zeros((0, len(LEVELS))), float(np.log(prior / (1 - prior))))
    inverse = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    known = keys[inverse] == hashes
    where, inverse, count = where[known], inverse[known], count[known]
    del hashes, known
    reached = [(where[count >= level], inverse[count >= level] * len(LEVELS) + k) for k, level in enumerate(LEVELS)]
    where, cell = (np.concatenate(x) for x in zip(*reached, strict=True))
    cells = len(keys) * len(LEVELS)
    in_p = np.bincount(cell, flags[where], cells)
    in_u = np.bincount(cell, ~flags[where], cells)
    rate_p, rate_u = in_p / n_p, (in_u + 0.5) / (n_u + 1)
    lift = (rate_p - rate_u) / np.sqrt(rate_u * (1 - np.minimum(rate_u, 0.999)) / n_p)
    good = np.flatnonzero((in_p >= MIN_COUNT) & (lift >= MIN_LIFT) & (rate_p > 1.5 * rate_u))
    chosen = np.sort(good[np.argsort(-lift[good], kind="stable")[:MAX_FEATURES]])
    column = np.full(cells, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(flags), len(chosen)), np.float32)
    used = column[cell] >= 0
    x[where[used], column[cell][used]] = 1
    weights, bias = nnpu(x[flags], x[~flags], prior)
    base, row = np.unique(chosen // len(LEVELS), return_inverse=True)
    table = np.zeros((len(base), len(LEVELS)))
    table[row, chosen % len(LEVELS)] = weights
    return Model(keys[base], table, bias)


def with_scores(docs: DataFrame, model: Model, text: str = "text", drop_text: bool = False, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; the text may be left out."""
    arrow_limits(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != name and not (drop_text and f.name == text)]
    spot = docs.columns.index(text)
    places = [docs.columns.index(f.name) for f in kept]
    inner = [f"c{k}" for k in range(len(docs.columns))]
    schema = T.StructType([*[T.StructField(f"c{k}", f.dataType) for k, f in enumerate(kept)], T.StructField("z", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.score(data, offsets) for _, _, data, offsets in text_slices(batch, f"c{spot}")]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in places], pa.array(np.concatenate(score) if score else np.zeros(0))], names=schema.fieldNames())

    return docs.toDF(*inner).mapInArrow(run, schema).toDF(*[f.name for f in kept], name)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = with_scores(docs, model, drop_text=True)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
