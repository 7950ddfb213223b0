"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a text's
word shingles, repeats included. Two fingerprints at Hamming distance 3 or less
differ in at most 3 of 6 blocks, so they agree on at least 3: each fingerprint
goes into one table for every choice of 3 blocks, keyed by those (about 32 bits, so
buckets stay small as the corpus grows), and pairs that share a bucket are
verified. Equal fingerprints are one node from the start, so a group of copies of
any size is one row. Within a bucket pairs are compared in numpy along the sorted
partition; only a spanning forest of the links leaves the task, never all pairs.
A bucket of more than ``HOT`` fingerprints, as a large family of near copies makes,
is split into shares and linked through common neighbours (``neighbour_links``), which
costs in proportion to its rows. Components follow by star contraction.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; a text with fewer words than a shingle is one shingle; repeated rows
and ids are kept, and all rows of one fingerprint share its class. A null id never
names a class unless the class has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.kernels import LOWER, SPACE, U64, arrow_limits, forest, mixed, spans, text_slices, tidy, xxh64
from corpusmill.plans.lineage import cut, passing, spread

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
#: Rows of a sorted partition that are compared at a time, besides a bucket that is larger.
RUN = 200_000
#: Rows of a bucket that are compared pair by pair; a larger one is split.
HOT = 1 << 14
#: Neighbours that are looked up at a time, and rows that are dealt to shares at a time.
PROBES, DEALT = 1 << 20, 1 << 16


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles in order, and the number of them in each text."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros(0, U64), np.zeros(len(offsets) - 1, np.int64)
    outside = SPACE[data]
    keep = ~outside
    keep[1:] |= ~outside[:-1]  # each word keeps one separator behind it
    moved = np.cumsum(keep) - 1
    flat = data[keep]
    flat[SPACE[flat]] = 0x20
    counts = np.diff(first)
    last = np.repeat(first[1:] - 1, counts)
    head = np.repeat(first[:-1], counts)
    at = np.arange(n)
    begins = np.flatnonzero((at + words - 1 <= last) | ((at == head) & (last - head + 1 < words)))
    stop = np.minimum(begins + words - 1, last[begins])
    from_, to = moved[starts[begins]], moved[ends[stop] - 1] + 1
    return xxh64(flat, from_, to - from_, seed), np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint per text: bits that are set in over half of its hashes."""
    out = np.zeros(len(counts), U64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # sums of at most 255 rows fit in a byte
        runs = -(-counts[full] // 255)
        begin = np.repeat(np.cumsum(counts[full]) - counts[full], runs)
        begin += 255 * (np.arange(len(begin)) - np.repeat(np.cumsum(runs) - runs, runs))
        part = np.add.reduceat(bits, begin, axis=0, dtype=np.uint8)
        ones = np.add.reduceat(part, np.cumsum(runs) - runs, axis=0, dtype=np.uint32)
        out[full] = np.packbits(ones * 2 > counts[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = SHINGLE, seed: int = SEED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of every document; fp is the fingerprint's bits as a long."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch):
                with np.errstate(over="ignore"):
                    fp = majority(*shingle_hashes(data, offsets, words, seed))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def block_masks(differ: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """One mask for each choice of the blocks that fingerprints at most ``differ`` bits apart may agree on."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    part = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    masks = [sum(part[k] for k in chosen) for chosen in combinations(range(blocks), blocks - differ)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def ball(mask: int, radius: int) -> np.ndarray:
    """Every choice of at most ``radius`` of the bits outside ``mask``."""
    bits = [1 << k for k in range(64) if not mask >> k & 1]
    return np.array([sum(chosen) for r in range(radius + 1) for chosen in combinations(bits, r)], U64)


def share(values: np.ndarray, bits: int) -> np.ndarray:
    """One of 2**bits shares for each value; the share of an exclusive or is the exclusive or of the shares."""
    with np.errstate(over="ignore"):
        masks = mixed(np.arange(1, bits + 1, dtype=U64))
    out = np.zeros(len(values), np.int64)
    for k in range(bits):
        out |= (np.bitwise_count(values & masks[k]) & 1).astype(np.int64) << k
    return out


class Steps:
    """The exclusive ors of a ball by their share."""

    def __init__(self, mask: int, radius: int, bits: int):
        steps = ball(mask, radius)
        shares = share(steps, bits)
        order = np.argsort(shares, kind="stable")
        self.steps, self.shares = steps[order], shares[order]

    def around(self, fp: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, neighbour) of all neighbours of ``fp`` whose steps have the wanted shares."""
        begin, end = (np.searchsorted(self.shares, wanted, side) for side in ("left", "right"))
        n = end - begin
        row = np.repeat(np.arange(len(fp)), n)
        return row, fp[row] ^ self.steps[np.arange(len(row)) + np.repeat(begin - np.cumsum(n) + n, n)]


def buckets(batches: Iterator[pa.RecordBatch], run: int = RUN) -> Iterator[list[np.ndarray]]:
    """The columns of whole buckets, ``run`` rows or more at a time, of a partition sorted by its first two columns."""
    held: list[list[np.ndarray]] = []
    rows = 0
    plain = lambda c: np.array(c.to_pylist(), dtype=object) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False)
    for batch in batches:
        held.append([plain(batch.column(k)) for k in range(batch.num_columns)])
        rows += batch.num_rows
        if rows >= run:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
            n = change[-1] + 1 if len(change) else 0  # the last bucket may go on in the next batch
            if n:
                yield [c[:n] for c in cols]
            held, rows = [[c[n:] for c in cols]], len(cols[0]) - n if n else 0
    if held and len(held[0][0]) + len(held) > 1:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]
    tidy()


def within(tab: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one bucket, a shift of the rows at a time."""
    group = np.concatenate([[0], np.cumsum((tab[1:] != tab[:-1]) | (key[1:] != key[:-1]))])
    at, lag = np.arange(len(tab)), 1
    while True:
        at = at[at + lag < len(tab)]
        at = at[group[at] == group[at + lag]]
        if not len(at):
            return
        yield at, at + lag
        lag += 1


def bucket_links(batches: Iterator[pa.RecordBatch], differ: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links inside each bucket of a partition sorted by (tab, key)."""
    for tab, key, fp, rep in buckets(batches):
        left, right, found = [], [], 0
        fp = fp.view(U64)  # numpy counts the bits of a signed number's absolute value
        for i, j in within(tab, key):
            near = np.bitwise_count(fp[i] ^ fp[j]) <= differ
            left.append(rep[i[near]])
            right.append(rep[j[near]])
            found += int(near.sum())
            if found > 1_000_000:
                a, b = forest(np.concatenate(left), np.concatenate(right))
                left, right, found = [a], [b], 0
        if found or len(left):
            a, b = forest(np.concatenate(left), np.concatenate(right))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _dealt_shares(batches: Iterator[pa.RecordBatch], masks: list[int], differ: int) -> Iterator[pa.RecordBatch]:
    """Each row (tab, key, bits, fp, rep) once for every share that has a neighbour of it."""
    reach = {}
    for batch in batches:
        tab, key, bits, fp, rep = (batch.column(k).to_numpy() for k in range(5))
        for t, b in sorted(set(zip(tab.tolist(), bits.tolist(), strict=True))):
            if (t, b) not in reach:
                reach[t, b] = np.unique(share(ball(masks[t], differ - differ // 2), b))
            at = np.flatnonzero((tab == t) & (bits == b))
            step = max(1, DEALT // len(reach[t, b]))
            for some in (at[k : k + step] for k in range(0, len(at), step)):
                row = np.repeat(some, len(reach[t, b]))
                own = (share(fp[some].view(U64), b)[:, None] ^ reach[t, b]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tab[row], key[row], bits[row], own, fp[row], rep[row])], names=["tab", "key", "bits", "share", "fp", "rep"])


def neighbour_links(fp: np.ndarray, rep: np.ndarray, near: Steps, far: Steps, wanted: np.ndarray, differ: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one share of the links of a bucket.

    Two fingerprints at most ``differ`` bits apart have a neighbour in common that is at most half of ``differ``
    away from one and the rest from the other. All that have one nearby neighbour, and all that have it as a farther
    one, are linked to the first of the former: each such link is one of at most ``differ`` bits.
    """
    row, spot = near.around(fp, wanted)
    spot, first = np.unique(spot, return_index=True)
    first = row[first]
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, PROBES // max(1, int(np.bincount(far.shares).max())))
    for a in range(0, len(fp) if len(spot) else 0, step):
        row, other = far.around(fp[a : a + step], wanted[a : a + step])
        at = np.minimum(np.searchsorted(spot, other), len(spot) - 1)
        hit = spot[at] == other
        i, j = a + row[hit], first[at[hit]]
        ok = (i != j) & (np.bitwise_count(fp[i] ^ fp[j]) <= differ)
        x, y = forest(np.concatenate([*left, rep[i[ok]]]), np.concatenate([*right, rep[j[ok]]]))
        left, right = [x], [y]
    return left[0], right[0]


def _share_links(batches: Iterator[pa.RecordBatch], masks: list[int], differ: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links of each share, of a partition sorted by (task, tab)."""
    steps = {}
    for _, tab, bits, own, fp, rep, key in buckets(batches):
        fp = fp.view(U64)
        order = np.lexsort((own, key, tab))
        edge = np.flatnonzero((np.diff(tab[order]) != 0) | (np.diff(key[order]) != 0) | (np.diff(own[order]) != 0)) + 1
        for at in np.split(order, edge):
            t, b = int(tab[at[0]]), int(bits[at[0]])
            if (t, b) not in steps:
                steps[t, b] = [Steps(masks[t], radius, b) for radius in (differ // 2, differ - differ // 2)]
            x, y = neighbour_links(fp[at], rep[at], *steps[t, b], share(fp[at], b) ^ own[at], differ)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])


def hot_buckets(nodes: DataFrame, rows: DataFrame, blocks: int, masks: list[int], most: int) -> tuple[Column, DataFrame] | None:
    """Which rows may be in a bucket of more than ``most``, and (tab, key, n) of those buckets; None if there are none.

    A bucket has no more rows than any of its blocks' values. Those are few, 2,048 a block, and counted first.
    """
    part = block_masks(blocks - 1, blocks)
    values = F.array(*[F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(p).cast("long")).alias("value")) for k, p in enumerate(part)])
    counts = nodes.select(F.explode(values).alias("v")).groupBy("v.block", "v.value").count().where(F.col("count") > most)
    full: list[list[int]] = [[] for _ in part]
    for found in counts.collect():
        full[found["block"]].append(found["value"])
    if not any(all(full[k] for k, p in enumerate(part) if p & m) for m in masks):
        return None
    inside = [F.col("fp").bitwiseAND(F.lit(p).cast("long")).isin(full[k]) if full[k] else F.lit(False) for k, p in enumerate(part)]
    may = F.lit(False)
    for t, m in enumerate(masks):
        here = F.col("tab") == t
        for k, p in enumerate(part):
            here = here & inside[k] if p & m else here
        may = may | here
    big = cut(rows.where(may).groupBy("tab", "key").agg(F.count("*").alias("n")).where(F.col("n") > most))
    return None if big.isEmpty() else (may, big)


def bucket_forests(nodes: DataFrame, differ: int, blocks: int, most: int) -> DataFrame:
    """(a, b): links of nodes (fp, rep) that have the components of all pairs at most ``differ`` bits apart."""
    masks = block_masks(differ, blocks)
    tables = F.array(*[F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)])
    rows = nodes.select(F.explode(tables).alias("t"), "fp", "rep").select("t.tab", "t.key", "fp", "rep")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = lambda rows: rows.repartition(parts, "tab", "key").sortWithinPartitions("tab", "key").mapInArrow(lambda batches: bucket_links(batches, differ), "a long, b long")
    hot = hot_buckets(nodes, rows, blocks, masks, most)
    if hot is None:
        return pairs(rows)
    may, big = hot
    cold = rows.where(~may).unionByName(rows.where(may).join(big, ["tab", "key"], "left_anti"))
    bits = F.ceil(F.log2(F.col("n") / most)).cast("int")
    dealt = rows.where(may).join(big, ["tab", "key"]).select("tab", "key", bits.alias("bits"), "fp", "rep")
    dealt = dealt.mapInArrow(lambda batches: _dealt_shares(batches, masks, differ), "tab int, key long, bits int, share long, fp long, rep long")
    dealt = dealt.select(F.xxhash64("tab", "key", "share").alias("task"), "tab", "bits", "share", "fp", "rep", "key")
    split = sorted_tasks(dealt, "tab").mapInArrow(lambda batches: _share_links(batches, masks, differ), "a long, b long")
    return pairs(cold).unionByName(split)


def classes(fps: DataFrame, differ: int = MAX_BITS, blocks: int = BLOCKS, hot: int = HOT) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of (doc_id, fp); buckets of more than ``hot`` are split."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    of = components(bucket_forests(nodes.where("rep IS NOT NULL"), differ, blocks, hot))
    return nodes.join(of, nodes["rep"] == of["id"], "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))


# Near-duplicates at a lower similarity. Two steps, each linear in the rows but for texts that are
# nearly as alike as wanted:
#
# 1. Pigeonhole blocks over SimHash prints of the distinct words. Of each bucket one text, the pivot,
#    is compared with the others: by Hamming distance, and where that is small exactly. The pivot is the text
#    with the most shingles that are common in a sample, in a large group of near copies the one that
#    most copies are nearest to. This links most of a large group by one comparison for each text.
# 2. The exact rest. Of two sets of shingles at a Jaccard similarity of t or more, each put in one and the
#    same order, the first m - ceil(t m) + 1 of either (its prefix; m is the set's size) have a shingle in
#    common. Texts of different components so far that meet there, and that neither sizes, places nor parities
#    rule out, are joined to candidate groups; in each group the sets are compared exactly.
#
# A key or group that is too large for a task is dealt out in chunks (``dealt``). Only spanning forests leave a task.
NEAR_WORDS = 5
SIMILARITY = 0.8
#: 64-bit prints of the distinct words, the blocks of each, how many a bucket shares, and the bits in which a text may differ from its pivot.
WORD_PRINTS, NEAR_BLOCKS, NEAR_PICK, NEAR_BITS = 2, 5, 2, 32
#: Texts whose shingles are counted to tell the common ones, and how many of those go last in the order.
SAMPLE, COMMON = 10_000, 100_000
#: Parity bits of a set, a power of two and at least twice its size: each tells whether an even or odd number of the
#: hashes fall on it. Two sets differ in at least as many shingles as their parities in bits.
PARITIES = 512
#: Pairs that are held at a time.
PAIRS = 1 << 17
#: Bytes of parities that are compared at a time.
PARITY_BYTES = 1 << 23
#: Rows of one key in a task, or shingles of one group in units of ``WEIGHT``.
CHUNK, WEIGHT = 1024, 512


def dealt(rows: DataFrame, keys: list[str], most: int | None = None) -> DataFrame:
    """The rows of keys that hold more than one ``part``, dealt to tasks of bounded weight.

    ``rows`` has ``node``, ``part`` and ``weight``. Pairs of one part needn't meet. A key of at most ``most`` is
    one task. Of a heavier one, the rows of its heaviest part and the others are cut into chunks, and each pair of
    chunks is a task but those of two chunks of that part: so a group that is linked but for a few texts
    costs no more than its rows times those few. Adds ``task``, the row's own ``chunk``, and whether the task is one ``whole`` chunk.
    """
    most = most or CHUNK
    weights = rows.groupBy(*keys).agg(F.sum("weight").alias("__n"), F.min("part").alias("__p"), F.max("part").alias("__q"))
    rows = cut(rows.join(weights.where("__p <> __q").drop("__p", "__q"), keys))
    task = lambda a, b: F.xxhash64(*keys, a, b).alias("task")
    kept = [c for c in rows.columns if c not in ("__n", "weight")]
    zero = F.lit(0).cast("long")
    cold = rows.where(F.col("__n") <= most).select(*kept, task(zero, zero), zero.alias("chunk"), F.lit(True).alias("whole"))
    hot = rows.where(F.col("__n") > most)
    shares = hot.groupBy(*keys, "part").agg(F.sum("weight").alias("w"))
    shares = shares.groupBy(*keys).agg(F.max_by("part", F.struct("w", "part")).alias("__main"), F.max("w").alias("__w"))
    first, second = (F.ceil(x / most).cast("long") for x in (F.col("__w"), F.col("__n") - F.col("__w")))
    spot = F.xxhash64("node", F.lit(1))
    own = F.when(F.col("part") == F.col("__main"), F.pmod(spot, first)).otherwise(first + F.pmod(spot, second))
    other = F.sequence(F.when(F.col("part") == F.col("__main"), first).otherwise(zero), first + second - 1)
    hot = hot.join(shares, keys).select(*kept, own.alias("chunk"), F.explode(other).alias("__other"))
    hot = hot.select(*kept, task(F.least("chunk", "__other"), F.greatest("chunk", "__other")), "chunk", (F.col("chunk") == F.col("__other")).alias("whole"))
    # a task of two chunks has rows of both: neither is whole; a row meets its own chunk in a task of its own
    return cold.unionByName(hot)


def sorted_tasks(rows: DataFrame, *order: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "task").sortWithinPartitions("task", *order)


def _distinct(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes in order, and their number."""
    of = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(of[new], minlength=len(counts))


def _common(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, sorted, that more than one of a sample of texts has, and the number of those texts."""
    every = max(1, texts.count() // SAMPLE)
    some = texts.where(F.pmod("th", F.lit(every)) == 0).select(F.col("th").alias("node"), "text").dropDuplicates(["node"])
    counts = some.mapInArrow(_shingle_sets(words), "node long, set array<long>").select(F.explode("set").alias("h")).groupBy("h").count()
    found = counts.where("count > 1").orderBy(F.desc("count"), "h").limit(COMMON).toArrow()
    hashes = found["h"].to_numpy().view(U64)
    order = np.argsort(hashes)
    return hashes[order], found["count"].to_numpy().astype(np.int32)[order]


def _prefixes(hashes: np.ndarray, counts: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The prefixes of sets of distinct hashes, each sorted, end to end, the length of each, and each set's number of common hashes."""
    of = np.repeat(np.arange(len(counts)), counts)
    rank = np.zeros(len(hashes), np.int32)
    if common is not None and len(common[0]):
        at = np.minimum(np.searchsorted(common[0], hashes), len(common[0]) - 1)
        rank = np.where(common[0][at] == hashes, common[1][at], 0)
        hashes = hashes[np.lexsort((hashes, rank, of))]
    size = np.minimum(counts, counts - np.ceil(similarity * counts - 1e-9).astype(np.int64) + 1)
    return hashes[np.arange(len(of)) - (np.cumsum(counts) - counts)[of] < size[of]], size, np.bincount(of, rank > 0, len(counts))


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values of the given sizes from bytes end to end."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _parities(hashes: np.ndarray, counts: np.ndarray) -> pa.Array:
    bits = np.left_shift(1, np.maximum(np.ceil(np.log2(np.maximum(2 * counts, PARITIES))).astype(np.int64), 1))
    begin = np.cumsum(bits) - bits
    at = np.repeat(begin, counts) + (hashes & np.repeat(bits - 1, counts).astype(U64)).astype(np.int64)
    return _binaries(np.packbits(np.bincount(at, minlength=int(bits.sum())).astype(np.uint8) & 1), bits // 8)


class Parities:
    """Parities of rows, to be compared at the shorter of two lengths."""

    def __init__(self, values: np.ndarray):
        data = np.frombuffer(b"".join(values), np.uint8)
        self.width = np.array([len(x) for x in values], np.int64)
        begin = np.cumsum(self.width) - self.width
        self.levels = {}
        for width in np.unique(self.width).tolist():
            spot = np.full(len(values), -1)
            rows = [np.flatnonzero(self.width == w) for w in (width, 2 * width)]
            spot[np.concatenate(rows)] = np.arange(sum(map(len, rows)))
            same, twice = (data[begin[r][:, None] + np.arange(w)] for r, w in zip(rows, (width, 2 * width), strict=True))
            self.levels[width] = spot, np.concatenate([same, twice[:, :width] ^ twice[:, width:]]).view(U64)

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bits in which rows i and j differ; 0 where one is over twice as long as the other."""
        out, shorter = np.zeros(len(i), np.int64), np.minimum(self.width[i], self.width[j])
        for width, (spot, table) in self.levels.items():
            every = np.flatnonzero((shorter == width) & (spot[i] >= 0) & (spot[j] >= 0))
            step = max(1, PARITY_BYTES // width)
            for at in (every[k : k + step] for k in range(0, len(every), step)):
                out[at] = np.bitwise_count(table[spot[i[at]]] ^ table[spot[j[at]]]).sum(axis=1)
        return out


def _sketches(words: int, similarity: float = SIMILARITY, common: tuple[np.ndarray, np.ndarray] | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch):
                with np.errstate(over="ignore"):
                    single = _distinct(*shingle_hashes(data, offsets, 1))
                    prints = [majority(mixed(single[0] + U64(k + 1)), single[1]).view(np.int64) for k in range(WORD_PRINTS)]
                    hashes, counts = shingle_hashes(data, offsets, words)
                    each = _distinct(hashes, counts)  # similarity is one of sets
                    at = np.cumsum(counts) - counts
                    place = mixed(np.arange(len(hashes), dtype=U64) - np.repeat(at, counts).astype(U64))
                    sums = np.concatenate([[U64(0)], np.cumsum(mixed(hashes ^ place))])
                    node = mixed(sums[at + counts] - sums[at] + counts.astype(U64))
                    prefix, size, known = _prefixes(*each, similarity, common)
                    rare = (32767 * (1 - known / np.maximum(each[1], 1))).astype(U64)
                    rank = (rare << U64(48)) | (mixed(node + U64(1)) >> U64(16))
                firsts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(prefix.view(np.int64)))
                own = [pa.array(rank.view(np.int64)), *map(pa.array, prints), pa.array(each[1].astype(np.int64)), firsts, _parities(*each)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(node.view(np.int64)), *own], names=["did", "th", "node", "rank", *_W, "m", "x", "p"])

    return run


_W = [f"w{k}" for k in range(WORD_PRINTS)]
_SKETCH = "did long, th long, node long, rank long, " + "".join(f"{w} long, " for w in _W) + "m long, x array<long>, p binary"


def _near_pivot(nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): texts that share a block of their words' prints with a pivot and are near enough to compare."""
    masks = block_masks(NEAR_BLOCKS - NEAR_PICK, NEAR_BLOCKS)
    tables = [F.struct(F.lit(k * len(masks) + t).alias("tab"), F.col(w).bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, w in enumerate(_W) for t, m in enumerate(masks)]
    keyed = nodes.where("m > 0").select(F.explode(F.array(*tables)).alias("t"), "rank").select("t.tab", "t.key", "rank")
    pivots = keyed.groupBy("tab", "key").agg(F.min("rank").alias("pivot"), F.max("rank").alias("last")).where("pivot <> last").drop("last")
    pairs = keyed.join(pivots, ["tab", "key"]).where("rank <> pivot").select("rank", "pivot").distinct()
    left, right = (nodes.select(F.col("rank").alias(r), F.col("node").alias(c), F.col("m").alias(f"{c}_m"), *[F.col(w).alias(f"{c}_{w}") for w in _W]) for r, c in (("rank", "a"), ("pivot", "b")))
    both = pairs.join(left, "rank").join(right, "pivot")
    differ = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in _W), F.lit(0))
    sizes = F.least("a_m", "b_m") >= similarity * F.greatest("a_m", "b_m") - 1e-9
    return both.where((differ <= NEAR_BITS) & sizes).select("a", "b")


def _across(group: np.ndarray, part: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group and different parts, of rows sorted by both, about ``PAIRS`` at a time."""
    n = len(group)
    ends = lambda new: np.repeat(np.append(np.flatnonzero(new) + 1, n), np.diff(np.concatenate([[0], np.flatnonzero(new) + 1, [n]])))
    edge = group[1:] != group[:-1]
    other = ends(edge | (part[1:] != part[:-1]))
    count = ends(edge) - other
    total = np.cumsum(count)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, total[a] - count[a] + PAIRS, "right")))
        i = np.repeat(np.arange(a, b), count[a:b])
        if len(i):
            yield i, other[i] + np.arange(len(i)) - np.repeat(total[a:b] - count[a:b] - total[a] + count[a], count[a:b])
        a = b


def _meeting(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """A spanning forest, in each task, of the pairs of different parts that may reach ``similarity``."""
    for task, key, node, part, pos, m, chunk, whole, parity in buckets(batches, RUN // 8):
        parities = Parities(parity)
        left, right, found = [], [], 0
        group = np.cumsum(np.concatenate([[0], (task[1:] != task[:-1]) | (key[1:] != key[:-1])]))
        for i, j in _across(group, part):
            sums = similarity / (1 + similarity) * (m[i] + m[j]) - 1e-9  # shingles that a pair must share
            at = whole[i] | (chunk[i] != chunk[j])
            at &= np.minimum(m[i], m[j]) >= similarity * np.maximum(m[i], m[j]) - 1e-9
            at &= np.minimum(m[i] - pos[i], m[j] - pos[j]) >= sums  # what is left behind the first shingle in common
            i, j, sums = i[at], j[at], sums[at]
            at = parities.differ(i, j) <= m[i] + m[j] - 2 * sums
            left.append(node[i[at]])
            right.append(node[j[at]])
            found += int(at.sum())
            if found > 1_000_000:
                a, b = forest(np.concatenate(left), np.concatenate(right))
                left, right, found = [a], [b], 0
        if found:
            a, b = forest(np.concatenate(left), np.concatenate(right))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _shingle_sets(words: int, packed: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch):
                hashes, counts = _distinct(*shingle_hashes(data, offsets, words))
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                sets = _binaries(hashes, 8 * counts) if packed else pa.ListArray.from_arrays(pa.array(at), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], names=["node", "set"])

    return run


def alike_in_group(part: np.ndarray, chunk: np.ndarray, whole: bool, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join the parts of one group as all pairs at ``similarity`` or more do."""
    m = np.array([len(x) for x in sets], np.int64)
    offsets = np.concatenate([[0], np.cumsum(m)])
    shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
    here = np.zeros(len(shingle) + 1, bool)
    root = np.unique(part, return_inverse=True)[1]
    links = []
    for i in range(len(m) - 1):
        able = (root[i + 1 :] != root[i]) & (np.minimum(m[i], m[i + 1 :]) >= similarity * np.maximum(m[i], m[i + 1 :]) - 1e-9)
        if not whole:
            able &= chunk[i + 1 :] != chunk[i]
        j = np.flatnonzero(able) + i + 1
        if not len(j):
            continue
        own = shingle[offsets[i] : offsets[i + 1]]
        here[own] = True
        first = np.cumsum(m[j]) - m[j]
        at = np.repeat(offsets[j] - first, m[j]) + np.arange(int(m[j].sum()))
        shared = np.add.reduceat(here[shingle[at]], first, dtype=np.int64)
        here[own] = False
        hit = j[shared >= similarity * (m[i] + m[j] - shared) - 1e-9]
        if len(hit):
            roots, at = np.unique(root[hit], return_index=True)
            links += [(i, k) for k in hit[at].tolist()]
            root[np.isin(root, roots)] = root[i]
    return links


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Links of each task's groups after exact comparison."""
    for task, key, node, part, chunk, whole, sets in buckets(batches, RUN // 64):
        edge = np.flatnonzero((task[1:] != task[:-1]) | (key[1:] != key[:-1])) + 1
        out = []
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(task)], strict=True):
            own = [np.frombuffer(x, U64) for x in sets[a:b]]
            out += [(a + i, a + j) for i, j in alike_in_group(part[a:b], chunk[a:b], bool(whole[a]), own, similarity)]
        if out:
            i, j = np.array(out).T
            yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])


def _sets(wanted: DataFrame, texts: DataFrame, nodes: DataFrame, words: int, packed: bool) -> DataFrame:
    """(node, set): the shingles of the wanted nodes."""
    wanted = wanted.join(nodes, "node").select("node", "rep.did", "rep.th")
    kind = "binary" if packed else "array<long>"
    return texts.join(wanted, ["did", "th"]).select("node", "text").mapInArrow(_shingle_sets(words, packed), f"node long, set {kind}").dropDuplicates(["node"])


def _alike(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles reach ``similarity``."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets(wanted, texts, nodes, words, packed=False)
    left, right = (sets.select(F.col("node").alias(c), F.col("set").alias(f"{c}_set")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(shared >= F.lit(similarity) * (F.size("a_set") + F.size("b_set") - shared) - 1e-9).select("a", "b")


def drop_near_duplicates(docs: DataFrame, words: int = NEAR_WORDS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document, that of the least id, of each group of near-duplicates.

    Texts are linked when the Jaccard similarity of their sets of word shingles reaches
    ``similarity``, all pairs of them; groups are the links' components, equal texts being one node from the start.
    """
    arrow_limits(docs.sparkSession)
    ident = [F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64(F.col(f"`{text}`")).alias("th")]
    texts = docs.select(*ident, F.col(f"`{text}`").alias("text"))
    with passing(docs.sparkSession):
        kept = cut(_kept(texts, words, similarity), keep=True)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *ident).join(kept, ["did", "th"])
    one = Window.partitionBy("did", "th").orderBy(F.lit(0))
    return whole.withColumn("n", F.row_number().over(one)).where("n = 1").select("__row.*")


def _kept(texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(did, th) of the text that stays of each group."""
    rows = texts.mapInArrow(_sketches(words, similarity, _common(texts, words)), _SKETCH)
    nodes = cut(rows.groupBy("node", "rank", *_W, "m").agg(F.min(F.struct("did", "th")).alias("rep"), F.first("x").alias("x"), F.first("p").alias("p")))

    links = cut(_alike(cut(_near_pivot(nodes, similarity)), texts, nodes, words, similarity))
    of = components(links)
    parted = nodes.join(of, nodes["node"] == of["id"], "left").withColumn("part", F.coalesce("component_id", "node"))
    parted = parted.select("node", "m", "x", "p", "part")
    prefixes = parted.select("node", "part", "m", F.posexplode("x").alias("pos", "key"), F.lit(1).alias("weight"))
    meeting = dealt(prefixes, ["key"]).join(parted.select("node", "p"), "node")
    meeting = sorted_tasks(meeting.select("task", "key", "node", "part", "pos", "m", "chunk", "whole", "p"), "key", "part")
    found = cut(meeting.mapInArrow(lambda batches: _meeting(batches, similarity), "a long, b long"))

    group = components(found)
    group = group.select(F.col("id").alias("node"), F.col("component_id").alias("key")).unionByName(group.select(F.col("component_id").alias("node"), F.col("component_id").alias("key")).distinct())
    members = group.join(parted, "node").select("key", "node", "part", F.ceil(F.col("m") / WEIGHT).alias("weight"))
    tasks = cut(dealt(members, ["key"]))
    sets = _sets(tasks.select("node").distinct(), texts, nodes, words, packed=True)
    tasks = sorted_tasks(tasks.join(sets, "node").select("task", "key", "node", "part", "chunk", "whole", "set"), "key")
    of = components(links.unionByName(cut(tasks.mapInArrow(lambda batches: _verified(batches, similarity), "a long, b long"))))
    kept = nodes.join(of, nodes["node"] == of["id"], "left").groupBy(F.coalesce("component_id", "node").alias("c")).agg(F.min("rep").alias("rep"))
    return kept.select("rep.did", "rep.th")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    fps = cut(fingerprints(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))))
    return fps.join(classes(fps), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
