"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are permuted by a keyed hash and cut into blocks of equal first hex
digits of the hash, as many digits as make a block about ``BLOCK_WORDS`` words or less (more where that would be too many blocks). A source's target gives an exact quota of words, hence of
block draws: whole epochs of all its blocks, then the permuted blocks up to the
rest, of which the last is cut inside the document where the quota ends. A binary
tree over the output shards splits the vector of per-source draw counts: at each
node the left half's share is one multivariate-hypergeometric draw, so the quotas
of all shards sum to the sources' exactly. Each shard then takes its disjoint run
of the permuted draws and orders its documents by a hash of its own.

The row side is DataFrame work only: one scan for the sizes, a map-side combined
sum per (source, block), a prefix over a source's blocks and a window
inside each block. No window or join ever holds a whole source's rows. The driver sees
one row per source (``MAX_SOURCES`` at most) and plans the tree over them: at most ``MAX_SHARDS``
shards, whose runs of draws (no more than there are block draws) are merged with the draws in order.

Defined results: rows of null id are permuted as one id, so they fall into one block; null text has size 0; null source is a source of its own, sorted
last; a source without words has target 0 and takes nothing. Repeated rows and
ids are documents of their own (equal rows may swap draws). An empty table gives
an empty result. Other columns are carried through, whatever their names, but one of the
result's own name (``mix`` unless another is given), which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.plans.lineage import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
#: Digits of the first sums; sources that need longer ones for blocks of ``BLOCK_WORDS`` are summed again.
FIRST_DIGITS, MAX_DIGITS = 3, 12
BLOCK_WORDS = 1 << 14
#: A block holds at least this share of all words, so their number has a bound.
MOST_BLOCKS = 1 << 20
SEED = "mix-1"
#: Words that an output shard holds about; the number of shards follows the mixture's size up to ``MAX_SHARDS``, then their size does.
SHARD_WORDS = 4_000_000
MAX_SHARDS = 1 << 16
MAX_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_times: int = MAX_TIMES) -> list[float]:
    """Target words of each source, in the order given: weights repeat, the shares sum to all
    words, and a target above ``max_times`` its source's size is cut there, the excess going
    to the others by weight until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out: dict[int, float] = {}
    total = sum(n for _, n in sizes)
    while len(out) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in out]
        rest, shared = total - sum(int(x) for x in out.values()), float(sum(w[i] for i in open_))
        share = {i: float(w[i] * rest) / shared for i in open_}
        above = [i for i in open_ if share[i] > max_times * sizes[i][1]]
        out |= {i: float(max_times * sizes[i][1]) for i in above} if above else share
    return [out[i] for i in range(len(sizes))]


def split_runs(counts: list[int], shards: int, seed: int = 17) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shard by shard, the sources that have block draws in it and how many; they sum to ``counts``."""
    rng = np.random.default_rng(seed)
    have = np.asarray(counts, dtype=np.int64)
    stack = [(0, shards, np.flatnonzero(have), have[have > 0])]
    while stack:
        first, n, of, have = stack.pop()
        if n == 1:
            yield first, of, have
            continue
        left = n // 2
        take = int(have.sum()) * left // n
        part = rng.multivariate_hypergeometric(have, take, method="marginals") if take else np.zeros_like(have)
        for at, own, size in ((first + left, have - part, n - left), (first, part, left)):
            stack.append((at, size, of[own > 0], own[own > 0]))


def split_tree(counts: list[int], shards: int, seed: int = 17) -> list[list[int]]:
    """Per shard, the block draws of each source; columns sum to ``counts``."""
    out = np.zeros((shards, len(counts)), np.int64)
    for shard, of, have in split_runs(counts, shards, seed):
        out[shard, of] = have
    return out.tolist()


def mix(docs: DataFrame, source: str = "source", size: Column | None = None, key: str = "doc_id", shards: int | None = None, split_last: bool = True, name: str = "mix") -> DataFrame:
    """``docs`` plus a struct, ``mix`` if not named, of size, source_size, target, draws and taken.

    ``draws`` lists (epoch, shard, words, place): ``place`` orders a shard. With
    ``split_last`` the last document of a quota gives only the words that are left;
    without, it is taken whole if at least half of it falls into the quota.
    """
    spark = docs.sparkSession
    size = n_words(F.col("text")) if size is None else size
    order = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != name]
    rows = docs.select(F.struct(*kept).alias("__row"), F.col(f"`{source}`").alias("__src"), size.alias("__size"), order.alias("__ord"))
    sums = cut(rows.groupBy("__src", F.substring("__ord", 1, FIRST_DIGITS).alias("__blk")).agg(F.sum("__size").alias("__bsize")))
    per_source = sums.groupBy("__src").agg(F.sum("__bsize").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per_source.sort(key=lambda r: (r[0] is None, (r[0] or "").encode()))
    goal = targets([(r[0], r["n"]) for r in per_source])
    shards = shards or min(MAX_SHARDS, max(1, -(-sum(r["n"] for r in per_source) // SHARD_WORDS)))
    block = max(BLOCK_WORDS, sum(r["n"] for r in per_source) // MOST_BLOCKS)
    digits = [next(k for k in range(MAX_DIGITS + 1) if k == MAX_DIGITS or r["n"] <= block * 16**k) for r in per_source]
    plan = [(n, r[0], d, r["n"], t, *(divmod(int(t + 0.5), r["n"]) if r["n"] else (0, 0))) for n, (r, t, d) in enumerate(zip(per_source, goal, digits, strict=True))]
    sources = F.broadcast(spark.createDataFrame(plan, "no int, src string, digits int, source_size long, target double, epochs long, rest long"))

    def blocked(some: DataFrame, place: str) -> DataFrame:
        """With each row's source number and block."""
        numbered = some.join(sources.select("no", "src", "digits"), F.col("__src").eqNullSafe(F.col("src")))
        return numbered.withColumn("blk", F.col(place).substr(F.lit(1), F.col("digits"))).drop("src", "digits", "__src")

    blocks = blocked(sums, "__blk").groupBy("no", "blk").agg(F.sum("__bsize").alias("bsize"))
    if max(digits, default=0) > FIRST_DIGITS:
        blocks = blocked(rows.select("__src", "__ord", "__size"), "__ord").groupBy("no", "blk").agg(F.sum("__size").alias("bsize"))
    before = Window.partitionBy("no").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("start", F.coalesce(F.sum("bsize").over(before), F.lit(0))).join(sources.drop("src", "digits"), "no")
    whole = F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)
    placed = placed.withColumn("epoch", F.when(F.col("epochs") > 0, whole).otherwise(F.array().cast("array<long>")))
    placed = cut(placed.withColumn("epoch", F.when(F.col("start") < F.col("rest"), F.concat("epoch", F.array("epochs"))).otherwise(F.col("epoch"))))

    # the tree's runs are merged with the draws in permuted order
    counted = {r["no"]: r["n"] for r in placed.groupBy("no").agg(F.sum(F.size("epoch")).alias("n")).collect()}
    at, runs = [0] * len(plan), []
    for shard, of, have in split_runs([counted.get(n, 0) for n in range(len(plan))], shards) if plan else ():
        for n, k in zip(of.tolist(), have.tolist(), strict=True):
            runs.append((n, at[n], shard))
            at[n] += k
    runs = spark.createDataFrame(runs, "no int, r long, shard int")
    rank = Window.partitionBy("no").orderBy("epoch", "blk")
    drawn = placed.select("no", "blk", F.explode("epoch").alias("epoch")).withColumn("r", (F.row_number().over(rank) - 1).cast("long"))
    both = drawn.withColumn("shard", F.lit(None).cast("int")).unionByName(runs, allowMissingColumns=True)
    so_far = Window.partitionBy("no").orderBy("r", F.col("epoch").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    drawn = both.withColumn("shard", F.last("shard", ignorenulls=True).over(so_far)).where("epoch IS NOT NULL")
    drawn = drawn.groupBy("no", "blk").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("drawn"))
    placed = placed.drop("epoch", "bsize").join(drawn, ["no", "blk"], "left")

    inside = Window.partitionBy("no", "blk").orderBy("__ord", "__size").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocked(rows, "__ord").withColumn("__in", F.coalesce(F.sum("__size").over(inside), F.lit(0))).join(placed, ["no", "blk"])
    last = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("rest") - F.col("start") - F.col("__in")))
    if not split_last:
        last = F.when(last * 2 >= F.greatest(F.col("__size"), F.lit(1)), F.col("__size")).otherwise(0)
    words = lambda d: F.when(d["epoch"] < F.col("epochs"), F.col("__size")).otherwise(F.col("__last"))
    draws = F.filter(
        F.transform(F.coalesce("drawn", F.array().cast("array<struct<epoch:bigint,shard:int>>")), lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), words(d).alias("words"), F.md5(F.concat_ws(":", d["shard"], d["epoch"], "__ord")).alias("place"))),
        lambda d: d["words"] > 0,
    )
    rows = rows.withColumn("__last", last.cast("long")).withColumn("draws", draws)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return rows.select("__row.*", F.struct(F.col("__size").alias("size"), "source_size", "target", "draws", taken.alias("taken")).alias(name))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    mixed = mix(cut(docs), size=F.col("size"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", F.size("mix.draws").alias("n_draws"))


ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
f AS (SELECT 0 AS step, no, n, w, CAST(NULL AS DOUBLE) AS target FROM w
  UNION ALL
  SELECT step + 1, no, n, w, CASE WHEN target IS NOT NULL THEN target WHEN share > 3 * n THEN CAST(3 * n AS DOUBLE) WHEN NOT any_above THEN share END
  FROM (SELECT *, coalesce(bool_or(target IS NULL AND share > 3 * n) OVER (), false) AS any_above FROM
    (SELECT *, CAST(w * CAST(sum(n) OVER () - coalesce(sum(target) OVER (), 0) AS BIGINT) AS DOUBLE) / CAST(sum(CASE WHEN target IS NULL THEN w END) OVER () AS DOUBLE) AS share FROM f) x) y
  WHERE step < 40),
t AS (SELECT source, w.n, f.target, CAST(floor(f.target + 0.5) AS BIGINT) AS q FROM f JOIN w USING (no) WHERE step = 40),
c AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT c.doc_id, c.size, t.n AS source_size, t.target,
  CAST(CASE WHEN t.n = 0 THEN 0 ELSE (t.q // t.n) * c.size + greatest(0, least(c.size, t.q % t.n - c.before)) END AS BIGINT) AS taken,
  CAST(CASE WHEN t.n = 0 THEN 0 ELSE (CASE WHEN c.size > 0 THEN t.q // t.n ELSE 0 END) + (CASE WHEN least(c.size, t.q % t.n - c.before) > 0 THEN 1 ELSE 0 END) END AS INTEGER) AS n_draws
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
"""
