"""numpy kernels over the bytes of whole Arrow columns: words, hashes, local unions.

Texts are handled as one byte buffer with offsets, about a megabyte at a time; a
text longer than that is a slice of its own, so memory follows the longest text,
never a group or a partition.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE = 1 << 20
U64 = np.uint64


def arrow_limits(spark) -> None:
    """Arrow batches of bounded size, whatever the length of the texts, and shuffle files that go when a query is over."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def tidy() -> None:
    """Hand freed memory back, which a Python worker would keep from one stage to the next."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets); null counts as empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(col)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
    tidy()


def byte_table(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACE = byte_table([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes not in ``outside``, and each text's first run."""
    inside = ~outside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    edge = np.empty(len(data) + 1, bool)
    edge[:-1] = inside
    edge[-1] = False
    starts, ends = edge.copy(), edge.copy()
    starts[1:] &= ~edge[:-1] | cut[1:]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside & (~edge[1:] | cut[1:])
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, U64), np.ones(1, U64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
        while len(_powers[k]) < n:
            have = _powers[k]
            _powers[k] = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U64(29))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span stands.

    Polynomials modulo 2**64 have known collisions from 1,024 bytes on; spans over 512 bytes take XXH64.
    """
    power, inverse = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[: len(data)], out=sums[1:])
    out = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))
    for k in np.flatnonzero(ends - starts > 512):
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes(), 42)
    return out


# Fixed values of XXH64.
_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x, r):
    return (x << U64(r)) | (x >> U64(64 - r))


def xxh64(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start : start + len]`` for every span at once."""
    with np.errstate(over="ignore"):
        return _xxh64(data, starts, lens, U64(seed))


def _xxh64(data, starts, lens, seed):
    padded = np.concatenate([data, np.zeros(32, np.uint8)])
    lane = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    word = np.ndarray((len(padded) - 3,), "<u4", padded.data, strides=(1,))
    turn = lambda acc, k: _rotl(acc + k * _P2, 31) * _P1
    h = np.full(len(starts), seed + _P5, U64)
    at, left = starts.astype(np.int64), lens.astype(np.int64).copy()
    at = at.copy()
    wide = np.flatnonzero(lens >= 32)
    huge = wide[lens[wide] > 4096]
    wide = wide[lens[wide] <= 4096]
    if len(wide):
        acc = [np.full(len(wide), x, U64) for x in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
        go = np.arange(len(wide))
        while len(go):
            pos = at[wide[go]]
            for k in range(4):
                acc[k][go] = turn(acc[k][go], lane[pos + 8 * k])
            at[wide[go]] += 32
            left[wide[go]] -= 32
            go = go[left[wide[go]] >= 32]
        x = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for k in range(4):
            x = (x ^ turn(U64(0), acc[k])) * _P1 + _P4
        h[wide] = x
    h += lens.astype(U64)
    go = np.flatnonzero(left >= 8)
    while len(go):
        h[go] = _rotl(h[go] ^ turn(U64(0), lane[at[go]]), 27) * _P1 + _P4
        at[go] += 8
        left[go] -= 8
        go = go[left[go] >= 8]
    go = np.flatnonzero(left >= 4)
    h[go] = _rotl(h[go] ^ (word[at[go]].astype(U64) * _P1), 23) * _P2 + _P3
    at[go] += 4
    left[go] -= 4
    go = np.flatnonzero(left > 0)
    while len(go):
        h[go] = _rotl(h[go] ^ (padded[at[go]].astype(U64) * _P5), 11) * _P1
        at[go] += 1
        left[go] -= 1
        go = go[left[go] > 0]
    h = (h ^ (h >> U64(33))) * _P2
    h = (h ^ (h >> U64(29))) * _P3
    h = h ^ (h >> U64(32))
    for k in huge:
        h[k] = xxhash.xxh64_intdigest(data[starts[k] : starts[k] + lens[k]].tobytes(), int(seed))
    return h


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node of the links a-b but the roots; a root is its class's least id."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        while not np.array_equal(new, hop := new[new]):
            new = hop
        if np.array_equal(new, label):
            break
        label = new
    kept = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[kept], nodes[label[kept]]
