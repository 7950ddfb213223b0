"""Token counts by trie-shared dynamic programming over a unigram vocabulary.

A text's pre-tokens are its runs of non-space bytes, each led by the vocabulary's
word mark. A unigram model gives every vocabulary piece a score, and a pre-token's
tokens are those of its best-scoring segmentation. The distinct pre-tokens of a
slice of text are inserted level by level into a trie (a node is a distinct prefix);
the forward score of a node, the best sum of scores of its prefix, is computed once
however many pre-tokens share it, and a terminal node's token count is what a
pre-token gets. Counts of pre-tokens met before are remembered by each Python worker
up to ``MEMO`` entries. Nothing is shuffled.

The vocabulary is a public one, whose path is a parameter. Its entries are ranked,
and the score of rank r is -log(r + 1), Zipf's law, in units of 2**-20 so that sums are
exact; a byte may stand alone at the score of rank ``BYTE_RANK``. Of equal sums
the one with fewer tokens counts.

Defined results: null and empty texts have no tokens; repeated rows are kept; other
columns aren't read. A pre-token longer than ``TRIE_DEPTH`` bytes is computed by the
same recurrence on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import U64, arrow_limits, mixed, span_hashes, spans, text_slices
from corpusmill.plans.lineage import spread

MEMO = 600_000
TRIE_DEPTH = 96
MARK = "▁"
BYTE_RANK = 10**12
_BASE = 0x100000001B3
#: A score and a token count in one number: fewer tokens win a tie.
STEP = 1 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> list[bytes]:
    """The vocabulary's pieces in rank order; the word mark, where it leads, is a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(b" " if p.startswith(MARK) else b"") + p.removeprefix(MARK).encode() for p in own if MARK not in p[1:]]


class Unigram:
    def __init__(self, vocabulary: list[bytes]):
        score = lambda rank: -int(round(np.log(rank + 1.0) * STEP))
        self.table: dict[bytes, int] = {}
        for rank, p in enumerate(vocabulary):
            self.table.setdefault(p, score(rank + 1))
        self.byte = score(BYTE_RANK)
        self.longest = max(map(len, self.table), default=1)
        by_length: dict[int, list[bytes]] = {}
        for p in self.table:
            by_length.setdefault(len(p), []).append(p)
        self.levels: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []  # length, sorted hashes, scores, filter
        self.power = np.array([pow(_BASE, k, 1 << 64) for k in range(self.longest + 1)], U64)
        for length, own in sorted(by_length.items()):
            hashes = np.array([self.rolled(p) for p in own], U64)
            order = np.argsort(hashes)
            seen = np.zeros(1 << 18, bool)
            seen[self.slot(hashes)] = True
            self.levels.append((length, hashes[order], np.array([self.table[own[k]] for k in order], np.int64), seen))
        self.known = np.zeros(0, U64)
        self.counts = np.zeros(0, np.int32)

    @staticmethod
    def rolled(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * _BASE + b + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (mixed(hashes) >> U64(46)).astype(np.int64)

    def alone(self, word: bytes) -> int:
        """Token count of one pre-token: the same recurrence without a trie."""
        best, count = [0], [0]
        for end in range(1, len(word) + 1):
            options = [(best[end - 1] + self.byte, -(count[end - 1] + 1))]
            for start in range(max(0, end - self.longest), end):
                s = self.table.get(word[start:end])
                if s is not None:
                    options.append((best[start] + s, -(count[start] + 1)))
            s, c = max(options)
            best.append(s)
            count.append(-c)
        return count[-1]

    def trie(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Token counts of distinct words (with the mark put before each), sharing prefixes."""
        out = np.zeros(len(starts), np.int32)
        # per level: each node's parent, rolled hash, best score and token count
        parent = [np.zeros(1, np.int64)]
        rolled, best, count = [np.zeros(1, U64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        live, node = np.arange(len(starts)), np.zeros(len(starts), np.int64)
        depth = 0
        while len(live):
            byte = data[starts[live] + depth - 1].astype(np.int64) if depth else np.full(len(live), 0x20)
            keys, node = np.unique(node * 256 + byte, return_inverse=True)
            depth += 1
            up = keys >> 8
            parent.append(up)
            rolled.append(rolled[-1][up] * U64(_BASE) + (keys & 255).astype(U64) + U64(1))
            top, tokens = best[-1][up] + self.byte, count[-1][up] + 1
            ancestor, far = np.arange(len(keys)), 0
            for length, hashes, scores, seen in self.levels:
                if length > depth:
                    break
                while far < length:
                    ancestor = parent[depth - far][ancestor]
                    far += 1
                h = rolled[depth] - rolled[depth - length][ancestor] * self.power[length]
                maybe = np.flatnonzero(seen[self.slot(h)])
                at = np.minimum(np.searchsorted(hashes, h[maybe]), len(hashes) - 1)
                same = hashes[at] == h[maybe]
                maybe, at = maybe[same], at[same]
                s, t = best[depth - length][ancestor[maybe]] + scores[at], count[depth - length][ancestor[maybe]] + 1
                better = (s > top[maybe]) | ((s == top[maybe]) & (t < tokens[maybe]))
                top[maybe[better]], tokens[maybe[better]] = s[better], t[better]
            best.append(top)
            count.append(tokens)
            ended = lens[live] == depth - 1
            out[live[ended]] = tokens[node[ended]]
            live, node = live[~ended], node[~ended]
        return out

    def word_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token count of every word, distinct ones computed once."""
        hashes, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        counts = np.zeros(len(hashes), np.int32)
        new = np.ones(len(hashes), bool)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            new = self.known[at] != hashes
            counts[~new] = self.counts[at[~new]]
        fresh = np.flatnonzero(new)
        if len(fresh):
            s, n = starts[first[fresh]], ends[first[fresh]] - starts[first[fresh]]
            short = n <= TRIE_DEPTH
            counts[fresh[short]] = self.trie(data, s[short], n[short])
            for k in np.flatnonzero(~short):
                counts[fresh[k]] = self.alone(b" " + data[s[k] : s[k] + n[k]].tobytes())
            if len(self.known) + len(fresh) > MEMO:
                self.known, self.counts = np.zeros(0, U64), np.zeros(0, np.int32)
            known = np.concatenate([self.known, hashes[fresh]])
            order = np.argsort(known, kind="stable")
            self.known, self.counts = known[order], np.concatenate([self.counts, counts[fresh]])[order]
        return counts[inverse]


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    return Unigram(pieces(path))


def token_counts(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every document."""
    path = path or default_path()
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        with np.errstate(over="ignore"):
            for batch in batches:
                for i, j, data, offsets in text_slices(batch):
                    starts, ends, first = spans(data, offsets)
                    sums = np.concatenate([[0], np.cumsum(model.word_counts(data, starts, ends), dtype=np.int64)])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(first)), pa.array(np.diff(sums[first]))], names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
