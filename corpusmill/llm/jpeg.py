"""Media columns as baseline JPEG: lossless storage of bytes, and thumbnails by reading it back.

Storage. A payload is UTF-8 bytes padded with spaces to a multiple of 192. A JPEG
holds entropy-coded quantised coefficients, and those are kept exactly, so they
are the unit here: one byte is one coefficient of size category 8, whose eight
appended bits are the byte itself. 192 bytes are the 3 x 64 coefficients, in
zigzag order, of one 4:4:4 minimum coded unit. Every unit is its own restart
interval, so DC predictions start anew and intervals decode independently. The
quantisation tables are all ones, the Huffman tables give category 8 the code 0
and category 0 / end of block the code 10, and a comment segment holds the number of
units; empty units fill the last row of the picture.

Reading. Markers are parsed for each picture; the scans of many pictures are then
Huffman-decoded together in numpy, one lane for each restart interval, one symbol
of every lane at a time. The reader takes any baseline picture (other tables and
sampling factors, with or without restarts); the DC values of the first component
give the luminance thumbnail. Progressive or arithmetic pictures raise ValueError.

Defined results: null text is empty and is stored as 192 spaces; equal texts give
equal values; repeated rows are kept; other columns aren't read; memory follows
the longest text. A text is limited by the picture's size to 12 GB.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import U64, arrow_limits, text_slices
from corpusmill.plans.lineage import spread

UNIT = 192
SLICE = 1 << 20
ACROSS = 256  # units in a row of the picture, more where it would be over SIDE units high
SIDE = 8191  # units of a side of 16 bits

# Fixed values of the JPEG format: the markers used here.
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, COM, APP0, RST0 = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE, 0xE0, 0xD0


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


_TABLES = _segment(DQT, b"\0" + b"\1" * 64)
_CODES = bytes([1, 1] + [0] * 14) + bytes([8, 0])
_SCAN = _segment(DHT, b"\x00" + _CODES) + _segment(DHT, b"\x10" + _CODES) + _segment(DRI, (1).to_bytes(2, "big")) + _segment(SOS, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0]))
#: A unit without payload: three blocks of DC category 0 and end of block, then ones.
_EMPTY = bytes([0b10101010, 0b10101111])


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All payloads end to end, and their offsets."""
    size = np.maximum(1, -(-np.diff(offsets) // UNIT)) * UNIT
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.full(at[-1], 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(at[:-1] - offsets[:-1], np.diff(offsets))] = data
    return out, at


def grid(n: int) -> tuple[int, int]:
    """Units across and down of a picture of n units."""
    w = min(n, max(ACROSS, -(-n // SIDE)))
    return w, -(-n // w)


def encode(payload: np.ndarray, at: np.ndarray) -> list[bytes]:
    """One JPEG for each payload ``payload[at[i] : at[i + 1]]``."""
    bits = np.zeros((len(payload), 9), np.uint8)
    bits[:, 1:] = np.unpackbits(payload[:, None], axis=1)
    units = np.packbits(bits.reshape(len(payload) // UNIT, UNIT * 9), axis=1)
    stuffed = (units == 0xFF).any(axis=1)
    first = at // UNIT
    number = np.arange(len(units)) - np.repeat(first[:-1], np.diff(first))
    rows = np.concatenate([units, np.full((len(units), 1), 0xFF, np.uint8), (RST0 + number % 8).astype(np.uint8)[:, None]], axis=1)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        w, h = grid(n)
        head = b"\xff\xd8" + _segment(APP0, b"JFIF\0\1\1\0\0\1\0\1\0\0") + _segment(COM, b"units %d" % n) + _TABLES
        head += _segment(SOF0, bytes([8]) + (8 * h).to_bytes(2, "big") + (8 * w).to_bytes(2, "big") + bytes([3, 1, 0x11, 0, 2, 0x11, 0, 3, 0x11, 0])) + _SCAN
        if stuffed[a:b].any():
            body = b"".join(bytes(r[:-2]).replace(b"\xff", b"\xff\0") + bytes(r[-2:]) for r in rows[a:b])
        else:
            body = rows[a:b].tobytes()
        fill = b"".join(_EMPTY + bytes([0xFF, RST0 + k % 8]) for k in range(n, w * h))
        out.append(head + (body + fill)[:-2] + b"\xff\xd9")
    return out


@dataclass
class Picture:
    width: int
    height: int
    parts: list[tuple[int, int, int]]  # id, horizontal, vertical sampling
    tables: dict[tuple[int, int], bytes]
    uses: dict[int, tuple[int, int]]
    restart: int
    units: int | None
    scan: tuple[int, int]

    @property
    def grid(self) -> tuple[int, int]:
        """Minimum coded units across and down."""
        if len(self.parts) == 1:
            return -(-self.width // 8), -(-self.height // 8)
        h, v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    @property
    def blocks(self) -> list[tuple[int, int, int]]:
        """Component, DC table and AC table of each block of a unit."""
        n = len(self.parts)
        return [(k, *self.uses[p[0]]) for k, p in enumerate(self.parts) for _ in range(1 if n == 1 else p[1] * p[2])]


def parse(media: bytes) -> Picture:
    """The markers up to the first scan."""
    if media[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, found = 2, {"restart": 0, "units": None, "tables": {}}
    while True:
        while media[at + 1] == 0xFF:
            at += 1
        marker, size = media[at + 1], int.from_bytes(media[at + 2 : at + 4], "big")
        body = media[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == SOF0:
            found |= {"height": int.from_bytes(body[1:3], "big"), "width": int.from_bytes(body[3:5], "big"), "parts": [(body[k], body[k + 1] >> 4, body[k + 1] & 15) for k in range(6, 6 + 3 * body[5], 3)]}
        elif 0xC1 <= marker <= 0xCF and marker != DHT:
            raise ValueError("only baseline pictures are read")
        elif marker == DHT:
            while body:
                n = sum(body[1:17])
                found["tables"][body[0] >> 4, body[0] & 15] = body[1 : 17 + n]
                body = body[17 + n :]
        elif marker == DRI:
            found["restart"] = int.from_bytes(body[:2], "big")
        elif marker == COM and body.startswith(b"units "):
            found["units"] = int(body[6:])
        elif marker == SOS:
            uses = {body[k]: (body[k + 1] >> 4, body[k + 1] & 15) for k in range(1, 1 + 2 * body[0], 2)}
            return Picture(uses=uses, scan=(at, len(media) - 2 if media.endswith(b"\xff\xd9") else len(media)), **found)


def lookup(table: bytes) -> np.ndarray:
    """For each 16 bits that may come: symbol * 32 + code length, or 0 for no code."""
    out, code, k = np.zeros(1 << 16, np.int32), 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            out[code << (16 - length) : (code + 1) << (16 - length)] = table[k] * 32 + length
            code, k = code + 1, k + 1
        code <<= 1
    return out


def decode(media: list[bytes]) -> list[np.ndarray]:
    """The quantised coefficients of each picture, (units, blocks of a unit, 64) in zigzag order."""
    pictures = [parse(m) for m in media]
    alike: dict[tuple, list[int]] = {}
    for k, p in enumerate(pictures):
        alike.setdefault((tuple(p.blocks), tuple(sorted(p.tables.items())), p.restart), []).append(k)
    out: list[np.ndarray] = [np.zeros(0)] * len(media)
    for (blocks, tables, restart), members in alike.items():
        for k, coefficients in zip(members, _decode_alike([media[k] for k in members], [pictures[k] for k in members], blocks, dict(tables), restart), strict=True):
            out[k] = coefficients
    return out


def _decode_alike(media, pictures, blocks, tables, restart):
    scans = [np.frombuffer(m, np.uint8)[p.scan[0] : p.scan[1]] for m, p in zip(media, pictures, strict=True)]
    raw = np.concatenate([*scans, np.zeros(16, np.uint8)])
    size = np.array([len(s) for s in scans])
    begin = np.cumsum(size) - size
    mark = np.flatnonzero(raw[:-1] == 0xFF)
    after = raw[mark + 1]
    rst = mark[(after >= RST0) & (after < RST0 + 8)]
    keep = np.ones(len(raw), bool)
    keep[mark[after == 0] + 1] = False
    keep[rst] = keep[rst + 1] = False
    moved = np.cumsum(keep) - keep
    flat = raw[keep]
    lanes = np.sort(np.concatenate([begin, rst + 2]))
    of = np.searchsorted(begin, lanes, "right") - 1
    units = np.array([p.grid[0] * p.grid[1] for p in pictures])
    turn = np.arange(len(lanes)) - np.searchsorted(of, np.arange(len(pictures)))[of]
    share = np.minimum(restart, units[of] - turn * restart) if restart else units[of]
    if (share <= 0).any() or not np.array_equal(np.bincount(of, share, minlength=len(units)).astype(int), units):
        raise ValueError("restart markers don't fit the picture's size")
    place = np.concatenate([[0], np.cumsum(share)[:-1]])
    coefficients = _lanes(flat, moved[lanes], share, place, blocks, tables)
    return np.split(coefficients, np.cumsum(units)[:-1])


def _lanes(flat, start, share, place, blocks, tables):
    """Decode all lanes in step: symbol after symbol, block after block."""
    flat = np.concatenate([flat, np.full(16, 0xFF, np.uint8)])
    words = np.ndarray((len(flat) - 7,), ">u8", flat.data, strides=(1,))
    codes = {k: lookup(t) for k, t in tables.items()}
    out = np.zeros((int(share.sum()), len(blocks), 64), np.int16)
    position = start.astype(np.int64) * 8
    predicted = np.zeros((len(start), max(b[0] for b in blocks) + 1), np.int64)
    limit = (len(flat) - 16) * 8

    def symbol(at, table):
        """Code length and symbol at each bit position, and the bits behind the code."""
        if len(at) and at.max() > limit:
            raise ValueError("a scan ends inside a unit")
        word = words[at >> 3].astype(U64) << (at & 7).astype(U64)
        entry = table[(word >> U64(48)).astype(np.int64)]
        if not entry.all():
            raise ValueError("a code that no table has")
        length, sym = entry & 31, entry >> 5
        size = sym & 15
        bits = ((word << length.astype(U64)) >> U64(1) >> (63 - size).astype(U64)).astype(np.int64)
        value = np.where(size > 0, np.where(bits >> np.maximum(size - 1, 0) != 0, bits, bits - (1 << size.astype(np.int64)) + 1), 0)
        return length + size, sym >> 4, size, value

    for unit in range(int(share.max())):
        live = np.flatnonzero(share > unit)
        for b, (part, dc, ac) in enumerate(blocks):
            at = position[live]
            used, _, _, value = symbol(at, codes[0, dc])
            at = at + used
            predicted[live, part] += value
            row = place[live] + unit
            out[row, b, 0] = predicted[live, part]
            k = np.zeros(len(live), np.int64)
            on = np.arange(len(live))
            whole = True  # all lanes are still in this block
            while len(on):
                used, run, size, value = symbol(at if whole else at[on], codes[1, ac])
                at_next = (at if whole else at[on]) + used
                k_next = (k if whole else k[on]) + np.where((size > 0) | (run == 15), run + 1, 64)
                if whole:
                    at, k = at_next, k_next
                else:
                    at[on], k[on] = at_next, k_next
                good = size > 0
                if good.all():
                    out[row if whole else row[on], b, k_next] = value
                else:
                    hit = np.flatnonzero(good)
                    out[(row if whole else row[on])[hit], b, k_next[hit]] = value[hit]
                rest = k_next < 63
                if not rest.all():
                    on, whole = on[rest], False
            position[live] = at
    return out


def payload_of(coefficients: np.ndarray, units: int) -> bytes:
    c = coefficients[:units]
    return np.where(c < 0, c + 255, c).astype(np.uint8).tobytes()


def thumbnail(picture: Picture, coefficients: np.ndarray) -> np.ndarray:
    """Luminance by DC values alone, one pixel a block (quantiser 1)."""
    across, down = picture.grid
    _, h, v = picture.parts[0] if len(picture.parts) > 1 else (0, 1, 1)
    dc = coefficients[:, : h * v, 0].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
    return np.clip(np.rint(dc / 8 + 128), 0, 255).astype(np.uint8)


def feature(picture: Picture, coefficients: np.ndarray) -> str:
    """Dimensions, the thumbnail's digest, and its 8 x 8 average hash."""
    t = thumbnail(picture, coefficients)
    small = t[np.ix_(np.arange(8) * t.shape[0] // 8, np.arange(8) * t.shape[1] // 8)]
    average = np.packbits(small > small.mean()).tobytes().hex()
    return f"{picture.width}x{picture.height}:{hashlib.md5(t.tobytes()).hexdigest()[:16]}:{average}"


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_media: bool = True) -> DataFrame:
    """Every document stored as a JPEG, with what reading the stored bytes back gives."""
    arrow_limits(docs.sparkSession)
    fields = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", media binary" * keep_media

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch, limit=SLICE):
                media = encode(*padded(data, offsets))
                rows = []
                for m, n, c in zip(media, np.diff(offsets).tolist(), decode(media), strict=True):
                    p = parse(m)
                    back = payload_of(c, p.units)
                    rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(m), hashlib.sha256(m).hexdigest(), feature(p, c), m))
                cols = [pa.array(x) for x in list(zip(*rows, strict=True))[: 7 + keep_media]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols], names=["doc_id", *[f.split()[0] for f in fields.split(", ")]])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id long, {fields}")


def op9_jpeg_media(spark, sf_dir: str) -> DataFrame:
    return media_columns(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), keep_media=False)
