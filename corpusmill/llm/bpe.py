"""BPE encoding and decoding by forced-boundary splitting.

A token never holds a byte pair that occurs inside no vocabulary entry, so a text
may be cut between the two bytes of any such pair without changing its encoding.
White space is in no entry at all: the first cuts are at ASCII white space, which
gives words. A word is normalised, split by the vocabulary's pattern, and each
piece is cut again at its own forced boundaries; the fragments are merged
independently and concatenated. Fragments and words come back often, so both are
remembered by each Python worker, up to ``MEMO`` entries, then forgotten. The words of
a slice of texts are looked up and their encodings concatenated in numpy; only new words
reach Python code.

The files of the public vocabularies are a parameter; merges come from there and
nothing is trained. No shuffle: every row is encoded where it is read.

Long fragments are merged from a heap, so a text of one word of any length takes n log n steps.

Defined results: null text is empty and gives no tokens; special tokens written in
a text are taken as themselves; repeated rows are kept; other columns aren't read
(``encode``) or are carried through (``encode_rows``).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import U64, arrow_limits, span_hashes, spans, text_slices
from corpusmill.plans.lineage import spread

MEMO = 800_000
#: Bytes of remembered encodings, and the longest fragment that is remembered.
MEMO_BYTES, MEMO_LENGTH = 1 << 28, 256
SLICE = 1 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others for letters from 256 on, in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder of a vocabulary with word ends: lower case, white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]], [p["type"] for p in steps], model["type"], spec["decoder"]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE", None):
            raise ValueError(f"not a vocabulary of this kind: {kinds}")
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.rank = {tuple(m): k for k, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.marks = tuple(t.encode() for t in self.special)
        self.letters = byte_letters()
        self.inside = {x[k : k + 2] for t in self.vocab for x in [t.removesuffix(self.end)] for k in range(len(x) - 1)}
        self.fragments: dict[tuple[str, bool], tuple[int, ...]] = {}
        self.forget()

    def merge(self, fragment: str, last: bool) -> tuple[int, ...]:
        """Ids of a fragment; ``last``: a piece ends with it. The lowest-ranked, leftmost pair merges first."""
        parts = list(fragment)
        if last:
            parts[-1] += self.end
        if len(parts) > MEMO_LENGTH:
            return tuple(self.vocab[p] for p in self.merged_long(parts))
        rank = self.rank.get
        none = len(self.rank)
        ranks = [rank(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank((parts[k], parts[k + 1]), none)
            if k:
                ranks[k - 1] = rank((parts[k - 1], parts[k]), none)
        return tuple(self.vocab[p] for p in parts)

    def merged_long(self, parts: list[str]) -> list[str]:
        """The same merges of many parts from a heap of (rank, place), in n log n steps."""
        rank, n = self.rank.get, len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, k) for k in range(n - 1) if (r := rank((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            j = after[k]
            if not parts[k] or j >= n or rank((parts[k], parts[j])) != r:
                continue  # one of them is part of another token by now
            parts[k], parts[j] = parts[k] + parts[j], ""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (r := rank((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p]

    def cuts(self, piece: str) -> list[str]:
        """The piece's fragments between its forced boundaries."""
        at = [0, *[k + 1 for k in range(len(piece) - 1) if piece[k : k + 2] not in self.inside], len(piece)]
        return [piece[a:b] for a, b in zip(at, at[1:], strict=False)]

    def piece_ids(self, piece: str) -> list[int]:
        ids: list[int] = []
        fragments = self.cuts("".join([self.letters[b] for b in piece.encode()]))
        for k, fragment in enumerate(fragments):
            key = (fragment, k == len(fragments) - 1)
            found = self.fragments.get(key)
            if found is None:
                found = self.merge(*key)
                if len(fragment) <= MEMO_LENGTH:
                    if len(self.fragments) >= MEMO:
                        self.fragments.clear()
                    self.fragments[key] = found
            ids.extend(found)
        return ids

    def word_ids(self, word: str) -> list[int]:
        ids: list[int] = []
        for k, part in enumerate(self.special_pattern.split(word) if "<|" in word else [word]):
            if k % 2:
                ids.append(self.special[part])
            elif part:
                # each letter is lowered by itself: no final sigma
                plain = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for piece in self.pattern.findall(plain):
                    ids.extend(self.piece_ids(piece))
        return ids

    def forget(self) -> None:
        """Empty the table of words: hashes in order, each one's entry, and pools of encodings."""
        self.known, self.entry = np.zeros(0, U64), np.zeros(0, np.int32)
        self.counts = np.zeros(0, np.int32)
        self.pools = [bytearray() for _ in range(3)]  # ids as text, token names as text, packed ids
        self.starts = [np.zeros(1, np.int64) for _ in range(3)]

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table entry of each word; new words are encoded and remembered."""
        with np.errstate(over="ignore"):
            hashes, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > MEMO or sum(map(len, self.pools)) > MEMO_BYTES:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != hashes
        fresh = np.flatnonzero(new)
        if len(fresh):
            ids = [self.word_ids(data[starts[k] : ends[k]].tobytes().decode()) for k in first[fresh]]
            texts = ([b"".join([b"%d " % i for i in x]) for x in ids], ["".join([self.names[i] + " " for i in x]).encode() for x in ids], [np.asarray(x, "<u2").tobytes() for x in ids])
            for k, own in enumerate(texts):
                self.starts[k] = np.concatenate([self.starts[k], len(self.pools[k]) + np.cumsum([len(x) for x in own])])
                self.pools[k] += b"".join(own)
            entry = np.arange(len(self.counts), len(self.counts) + len(fresh), dtype=np.int32)
            self.counts = np.concatenate([self.counts, np.array([len(x) for x in ids], np.int32)])
            self.entry = np.insert(self.entry, at[fresh], entry)
            self.known = np.insert(self.known, at[fresh], hashes[fresh])
            at = np.searchsorted(self.known, hashes)
        return self.entry[at][inverse]

    def joined(self, pool: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries' encodings end to end, and where each begins."""
        begin = self.starts[pool][entries]
        size = self.starts[pool][entries + 1] - begin
        out = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat((begin - out[:-1]).astype(np.int32), size)
        source += np.arange(out[-1], dtype=np.int32)
        return np.frombuffer(self.pools[pool], np.uint8)[source] if len(source) else np.zeros(0, np.uint8), out

    def ids(self, text: str) -> list[int]:
        return [i for w in text.encode().split() for i in self.word_ids(w.decode())]

    def decode(self, ids) -> str:
        return " ".join([self.names[i] for i in ids])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the decoded text."""
    path = path or default_path()
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for i, j, data, offsets in text_slices(batch, limit=SLICE):
                starts, ends, first = spans(data, offsets)
                entries = bpe.entries(data, starts, ends)
                tokens = np.concatenate([[0], np.cumsum(bpe.counts[entries], dtype=np.int64)])[first]
                digests = []
                for pool in (0, 1):
                    out, at = bpe.joined(pool, entries)
                    at, out = at[first].tolist(), out.data
                    digests.append([hashlib.sha256(out[a : max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:], strict=False)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(tokens)), *map(pa.array, digests)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_rows(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): the ids themselves, packed as little-endian 16-bit numbers."""
    path = path or default_path()
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for i, j, data, offsets in text_slices(batch, limit=SLICE):
                starts, ends, first = spans(data, offsets)
                entries = bpe.entries(data, starts, ends)
                tokens = np.concatenate([[0], np.cumsum(bpe.counts[entries], dtype=np.int64)])[first]
                out, at = bpe.joined(2, entries)
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at[first]), pa.py_buffer(out)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(tokens)), ids], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return encode(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
