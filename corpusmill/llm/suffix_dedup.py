"""Exact substring dedup with a run-length compressed index.

Every byte that lies in a 200-byte string which also starts anywhere else in the
corpus is removed. A corpus-wide index can't be one task, so windows are first
dealt by content and then indexed in blocks:

1. Anchors. The least 16-gram hash of a 200-byte window is its anchor, so equal
   windows have equal anchors at equal offsets. The windows of one anchor are
   consecutive; their union, at most 384 bytes, is a context. One pass over the
   texts gives (anchor, content hash, place) of each context, no text.
2. Equal contexts become one row with a count before anything else is moved, and
   anchors seen once are dropped: their windows are nowhere else.
3. The contexts of each remaining anchor meet in a block of bounded size. Over the
   block the Burrows-Wheeler transform of the windows is built by prefix tripling
   and run-compressed. Common-prefix lengths with both neighbours are computed by
   comparison at the sampled run heads and ends alone; between samples they follow in
   text order, one less per step. That streams every window's matching
   statistic against the rest of the block, and windows of at least 200 are marked.
   A context that was counted more than once is marked whole.
4. Marks go back to the documents that hold the context.

Two contexts of one text share at most 199 bytes, so a text never matches its own overlap.
An anchor with more than ``MAX_GROUP`` different contexts (a passage that very many
documents embed, each between other words) is split: its contexts are cut into runs of
8 windows, then of single ones, dealt by the bytes common to a run and resolved the same way.
Single windows of one key are equal, so no group outgrows a task, and nothing is dropped.

Contexts count as equal when their anchors (64 bits) and contents (64 bits) have equal hashes; different ones are
compared byte by byte through the index.

Defined results: null text is empty; texts under 200 bytes keep everything; repeated rows are
each other's copies, whatever their number; rows are told apart by id and text hash, so ids may
repeat or be null (equal rows are read as one with a count); other columns are carried through by ``strip_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.kernels import U64, arrow_limits, mixed, span_hashes, text_slices
from corpusmill.plans.lineage import cut, passing, spread

LENGTH = 200
GRAM = 16
PIECE = 1 << 24
BLOCK = 1_500_000
MAX_GROUP = 2_048
#: Ranks below it are packed three to a number and sorted at once; in larger blocks by three columns.
FIELD = 1 << 21
#: Windows of a split context, level by level; 0 stands for the anchor's own.
LEVELS = (0, 8, 1)
_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_ROWS = "key long, ctx long, did long, th long, at int, len int"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on (zeros follow the end)."""
    x = _BYTE[data]
    for step in (1, 2, 4, 8):
        y = x * U64(0xD6E8FEB86659FD93 + 2 * step)
        y[: len(x) - step] += x[step:]
        x = y
    return mixed(x)


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, anchor hash, first byte and length of each context, places within the texts."""
    out = []
    for a in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        part = data[a : a + PIECE + LENGTH - 1]
        n, w = len(part), LENGTH - GRAM + 1
        x = gram_hashes(part)
        low = U64((1 << 25) - 1)
        least = (x & ~low) | np.arange(n, dtype=U64)
        span = 1
        while span * 2 <= w:
            least[: n - span] = np.minimum(least[: n - span], least[span:])
            span *= 2
        if w > span:
            least[: n - (w - span)] = np.minimum(least[: n - (w - span)], least[w - span :])
        # windows inside one text
        last = np.full(n, -1, np.int64)
        of = np.searchsorted(offsets, np.arange(a, a + n), "right") - 1 if len(offsets) > 2 else np.zeros(n, np.int64)
        last = offsets[of + 1] - LENGTH - a
        start = np.flatnonzero((np.arange(n) <= last) & (np.arange(n) <= n - LENGTH))
        if not len(start):
            continue
        anchor = (least[start] & low).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        final = np.append(first[1:], len(start)) - 1
        out.append((of[start[first]], x[anchor[first]], start[first] + a, start[final] - start[first] + LENGTH))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        did, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i, _, data, offsets in text_slices(batch):
            with np.errstate(over="ignore"):
                of, key, start, size = contexts(data, offsets)
                content = span_hashes(data, start, start + size)
            cols = [key.view(np.int64), content.view(np.int64), did[i + of], th[i + of], (start - offsets[of]).astype(np.int32), size.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "ctx", "did", "th", "at", "len"])


def _anchors(data: np.ndarray, offsets: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of the anchor in each context: the first gram of that hash in its last window."""
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    found = np.flatnonzero((gram_hashes(data) == np.repeat(key, size)) & (place >= np.repeat(size - LENGTH, size)))
    return place[found[np.searchsorted(found, offsets[:-1])]]


def _split_rows(windows: int):
    """Contexts of hot anchors cut into runs of windows, keyed by the bytes common to a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, ctx, n = (batch.column(k).to_numpy() for k in range(3))
            for i, _, data, offsets in text_slices(batch, "text"):
                size = np.diff(offsets)
                count = size - LENGTH + 1
                of = np.repeat(np.arange(len(size)), count)
                at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                own = key[i : i + len(size)].view(U64)
                with np.errstate(over="ignore"):
                    # runs are aligned to the anchor, which lies in all windows and leftmost in the last
                    back = np.zeros(len(of), np.int64) if windows == 1 else (_anchors(data, offsets, own)[of] - at) // windows
                    new = np.ones(len(of), bool)
                    new[1:] = (of[1:] != of[:-1]) | (back[1:] != back[:-1]) | (windows == 1)
                    first = np.flatnonzero(new)
                    last = at[np.append(first[1:], len(of)) - 1]
                    of, at, back = of[first], at[first], back[first]
                    ends = last + LENGTH
                    if windows == 1:
                        from_, to, turn = at, ends, own[of]
                    else:
                        from_ = _anchors(data, offsets, own)[of] - back * windows
                        to, turn = from_ - windows + 1 + LENGTH, own[of] + back.astype(U64)
                    core = span_hashes(data, offsets[of] + from_, offsets[of] + to)
                    sub = mixed(core + mixed(turn))
                    content = span_hashes(data, offsets[of] + at, offsets[of] + ends)
                cols = [sub.view(np.int64), content.view(np.int64), key[i + of], ctx[i + of], at.astype(np.int32), (ends - at).astype(np.int32), n[i + of]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "ctx", "did", "th", "at", "len", "n"])

    return run


class RunLengthIndex:
    """Windows of a block of contexts in Burrows-Wheeler order, run-compressed.

    ``order`` lists window starts sorted by their 200 bytes, equal windows by place. Row k's
    transform letter is the byte before its window, or none where a context begins. Rows
    whose letter differs from the row before are run heads; together with the rows whose left
    neighbours aren't adjacent (a window there is the last of its context) they are the samples.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, n = data, offsets, len(data)
        self.size = np.diff(offsets)
        self.left = np.repeat(offsets[1:], self.size) - np.arange(n)  # bytes up to the context's end
        self.ranks: list[tuple[int, np.ndarray]] = []
        wide = np.ndarray((n,), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]).data, strides=(1,))
        at = np.flatnonzero(self.left >= 8)
        self._rank(8, at, wide[at].astype(U64))
        for h in (24, 72):
            lower, r = self.ranks[-1]
            at = np.flatnonzero(self.left >= h)
            self._rank(h, at, r[at], r[at + lower], r[at + 2 * lower])
        r = self.ranks[-1][1]
        at = np.flatnonzero(self.left >= LENGTH)
        self.order = at[self._sorted(r[at], r[at + 72], r[at + LENGTH - 72], kind="stable")[0]]
        self.row = np.full(n, -1, np.int64)
        self.row[self.order] = np.arange(len(self.order))

    @staticmethod
    def _sorted(*keys: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The order of rows by ``keys``, and which of them, in order, differ from the row before."""
        if len(keys) == 3 and max((int(k.max()) for k in keys if len(k)), default=0) < FIELD:
            a, b, c = keys
            keys = ((a.astype(np.int64) << 42) | (b.astype(np.int64) << 21) | c,)
        order = np.argsort(keys[0], kind=kind) if len(keys) == 1 else np.lexsort(keys[::-1])
        new = np.zeros(max(len(order) - 1, 0), bool)
        for k in keys:
            new |= k[order[1:]] != k[order[:-1]]
        return order, new

    def _rank(self, h: int, at: np.ndarray, *keys: np.ndarray) -> None:
        order, new = self._sorted(*keys)
        rank = np.empty(len(at), np.int32)
        rank[order] = np.concatenate([[0], np.cumsum(new)])[: len(order)]
        full = np.full(len(self.data), -1, np.int32)
        full[at] = rank
        self.ranks.append((h, full))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at i and j, within their contexts."""
        out = np.zeros(len(i), np.int64)
        most = np.minimum(self.left[i], self.left[j])
        for h, rank in reversed(self.ranks):
            go = np.arange(len(i))
            while len(go):
                go = go[most[go] - out[go] >= h]
                go = go[rank[i[go] + out[go]] == rank[j[go] + out[go]]]
                out[go] += h
        go = np.arange(len(i))
        while len(go):
            go = go[out[go] < most[go]]
            go = go[self.data[i[go] + out[go]] == self.data[j[go] + out[go]]]
            out[go] += 1
        return out

    def statistics(self) -> np.ndarray:
        """At each window, the length of its longest match with either neighbour; 0 elsewhere."""
        best = np.zeros(len(self.data), np.int64)
        if len(self.order) < 2:
            return best
        starts = np.zeros(len(self.data), bool)
        starts[self.offsets[:-1][self.size > 0]] = True
        begins = starts[self.order]
        letter = np.where(begins, -1, self.data[np.maximum(self.order - 1, 0)].astype(np.int64))
        upper, lower = self.order[:-1], self.order[1:]
        change = (letter[1:] != letter[:-1]) | begins[1:] | begins[:-1]
        change |= self.row[np.maximum(upper - 1, 0)] + 1 != self.row[np.maximum(lower - 1, 0)]
        # neighbour above: samples are run heads; neighbour below: run ends. Both see the same pairs.
        sampled = self.common(upper[change], lower[change])
        for place in (lower, upper):
            known = np.full(len(self.data), -1, np.int64)
            alone = self.order[:1] if place is lower else self.order[-1:]
            known[alone] = 0
            known[place[change]] = sampled
            at = np.sort(self.order)
            seen = np.maximum.accumulate(np.where(known[at] >= 0, np.arange(len(at)), -1))
            source = at[seen]
            best[at] = np.maximum(best[at], known[source] - (at - source))
        return best


def repeated_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, last) of the runs of window starts that match elsewhere in the block."""
    hit = np.flatnonzero(RunLengthIndex(data, offsets).statistics() >= LENGTH)
    of = np.searchsorted(offsets, hit, "right") - 1
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(hit))[: len(first)] - 1
    return of[first], hit[first] - offsets[of[first]], hit[final] - offsets[of[first]]


def _index_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions sorted by key: blocks of whole keys, indexed; marks of contexts seen once."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def block(key, ctx, n, text):
        lens = np.array([len(x) for x in text], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lens)])
        of, first, last = repeated_runs(np.frombuffer(b"".join(text), np.uint8), offsets)
        once = n[of] == 1
        of, first, last = of[once], first[once], last[once]
        hit, at = np.unique(of, return_index=True)
        runs = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], names=["a", "b"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(of)).astype(np.int32)), runs)
        return pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(ctx[hit]), lists], names=["key", "ctx", "runs"])

    for batch in batches:
        key, ctx, n = (batch.column(k).to_numpy() for k in range(3))
        text = np.array(batch.column(3).to_pylist(), dtype=object)
        held.append((key, ctx, n, text))
        size += sum(map(len, text))
        if size >= BLOCK:
            key, ctx, n, text = (np.concatenate(x) for x in zip(*held, strict=True))
            edge = np.flatnonzero(key[1:] != key[:-1])
            if len(edge):
                k = edge[-1] + 1
                for a, b in _pieces(key[:k], text[:k]):
                    yield block(key[a:b], ctx[a:b], n[a:b], text[a:b])
                held = [(key[k:], ctx[k:], n[k:], text[k:])]
                size = sum(map(len, text[k:]))
            else:
                held = [(key, ctx, n, text)]
    if held:
        key, ctx, n, text = (np.concatenate(x) for x in zip(*held, strict=True))
        for a, b in _pieces(key, text):
            yield block(key[a:b], ctx[a:b], n[a:b], text[a:b])


def _pieces(key: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole keys of about a block."""
    a, size, edges = 0, 0, set((np.flatnonzero(key[1:] != key[:-1]) + 1).tolist())
    for k, x in enumerate(text):
        if size >= BLOCK and k in edges:
            yield a, k
            a, size = k, 0
        size += len(x)
    if len(text):
        yield a, len(text)


def _resolve(rows: DataFrame, texts: DataFrame, level: int = 0) -> DataFrame:
    """(key, ctx, runs) of contexts with repeated windows; rows: places of contexts, with their count n."""
    kinds = rows.groupBy("key", "ctx").agg(F.sum("n").alias("n"), F.min(F.struct("did", "th", "at", "len")).alias("rep"))
    totals = kinds.groupBy("key").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    found = cut(kinds.join(totals, "key").select("key", "ctx", "n", "kinds", "rep.*"))
    runs = F.array(F.struct(F.lit(0).alias("a"), (F.col("len") - LENGTH).alias("b")))
    marks = found.where("n > 1").select("key", "ctx", runs.alias("runs"))
    open_ = found.where("kinds > 1")
    body = F.substring(F.col("text").cast("binary"), F.col("at") + 1, F.col("len"))
    content = lambda some: some.join(texts, ["did", "th"]).select("key", "ctx", "n", body.alias("text"))
    cold = open_ if level == len(LEVELS) - 1 else open_.where(F.col("kinds") <= MAX_GROUP)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = content(cold).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_index_blocks, "key long, ctx long, runs array<struct<a:int,b:int>>")
    marks = marks.unionByName(cut(indexed))
    if level < len(LEVELS) - 1 and not (hot := open_.where(F.col("kinds") > MAX_GROUP)).isEmpty():
        hot = cut(content(hot).dropDuplicates(["key", "ctx"]))
        sub = cut(hot.mapInArrow(_split_rows(LEVELS[level + 1]), _ROWS + ", n long"))
        inner = _resolve(sub, hot.select(F.col("key").alias("did"), F.col("ctx").alias("th"), "text"), level + 1)
        marks = marks.unionByName(_spread(sub, inner).select(F.col("did").alias("key"), F.col("th").alias("ctx"), "runs"))
    return marks


def _spread(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """(did, th, runs): the marks of contexts at their places in each text."""
    moved = F.transform("runs", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b")))
    return rows.select("key", "ctx", "did", "th", "at").join(marks, ["key", "ctx"]).groupBy("did", "th").agg(F.flatten(F.collect_list(moved)).alias("runs"))


def with_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__runs``: first and last start of the repeated windows, in no order; null for none."""
    spark = docs.sparkSession
    arrow_limits(spark)
    ident = [F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(-(1 << 63))).alias("did"), F.xxhash64(F.col(f"`{text}`")).alias("th")]
    texts = docs.select(*ident, F.col(f"`{text}`").alias("text")).where(F.octet_length("text") >= LENGTH)
    with passing(spark):
        more = cut(texts.groupBy("did", "th").agg(F.count("*").alias("n")).where("n > 1"))
        if more.isEmpty():
            rows = cut(texts.mapInArrow(_context_rows, _ROWS).withColumn("n", F.lit(1).cast("long")))
        else:  # equal rows go on as one
            once = texts.join(more.select("did", "th"), ["did", "th"], "left_anti")
            again = texts.join(more, ["did", "th"]).groupBy("did", "th").agg(F.first("text").alias("text"))
            texts = cut(once.unionByName(again))
            rows = texts.mapInArrow(_context_rows, _ROWS).join(more, ["did", "th"], "left")
            rows = cut(rows.withColumn("n", F.coalesce("n", F.lit(1).cast("long"))))
        runs = cut(_spread(rows, _resolve(rows, texts)), keep=True)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *ident)
    return whole.join(runs, ["did", "th"], "left").select("__row", F.col("runs").alias("__runs"))


def covered(n: int, runs) -> np.ndarray:
    """Bytes inside marked windows."""
    edge = np.zeros(n + 1, np.int32)
    if len(runs):
        a, b = np.asarray(runs, dtype=np.int64).T
        np.add.at(edge, a, 1)
        np.add.at(edge, b + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _run_lists(column: pa.Array) -> list[np.ndarray]:
    """Each row's runs as an (m, 2) array."""
    flat = column.flatten()
    pairs = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], axis=1) if len(flat) else np.zeros((0, 2), np.int64)
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.split(pairs, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, out = _run_lists(batch.column(2)), []
        for i, j, data, offsets in text_slices(batch):
            for k in range(i, j):
                own = data[offsets[k - i] : offsets[k - i + 1]]
                if len(runs[k]):
                    gone = covered(len(own), runs[k])
                    out.append((len(own), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(own[~gone].tobytes()).hexdigest()))
                else:
                    out.append((len(own), 0, 0, hashlib.sha256(own.tobytes()).hexdigest()))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    runs = with_runs(docs).select(F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__row.text").alias("text"), "__runs")
    return runs.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, kept = _run_lists(batch.column(2)), []
        for i, j, data, offsets in text_slices(batch):
            for k in range(i, j):
                own = data[offsets[k - i] : offsets[k - i + 1]]
                gone = covered(len(own), runs[k]) if len(runs[k]) else None
                if gone is not None:
                    # a character goes only with all of its bytes
                    lead = np.flatnonzero((own & 0xC0) != 0x80)
                    whole = np.logical_and.reduceat(gone, lead) if len(lead) else gone[:0]
                    gone = np.repeat(whole, np.diff(np.append(lead, len(own))))
                    own = own[~gone]
                kept.append(own.tobytes().decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["row", "text"])


def strip_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut out of the text, by whole characters; null stays null."""
    marked = with_runs(docs)
    row = marked.schema["__row"].dataType
    hit = marked.where("__runs IS NOT NULL")
    done = hit.select("__row", F.col(f"__row.`{text}`").alias("text"), "__runs").mapInArrow(_stripped, T.StructType([T.StructField("row", row), T.StructField("text", T.StringType())]))
    done = done.select(F.col("row").withField(f"`{text}`", F.col("text")).alias("row"))
    return marked.where("__runs IS NULL").select(F.col("__row").alias("row")).unionByName(done).select("row.*")


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
