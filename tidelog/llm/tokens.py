"""Byte-level BPE ids of a public vocabulary, for whole corpora and for pre-tokens of any length.

Merges of a pre-token are taken from a queue of ranks: a bucket per merge rank holds the places in a linked list of symbols
where that merge may happen, and a hierarchy of bitmaps tells by find-first-set which rank is the next that has any. Places whose
pair has changed meanwhile are stale and skipped. A pre-token of n bytes costs n pushes, however long it is; the queue is empty
afterwards and serves the next one. Pre-tokens met before are remembered up to a bound.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

FOLDER = "/opt/tokenizers"
#: The pre-tokens of this family of vocabularies: contractions, letters, digits and other signs with a blank before, blanks. A fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens that a worker remembers, up to which length, and pairs of symbols: some ten MB each, whatever the corpus.
REMEMBERED, SHORT, PAIRS = 100_000, 64, 300_000


def ranks(name: str = "byte_bpe_50k", folder: str = FOLDER) -> dict[bytes, int]:
    """The ranks of a vocabulary file, which is read here and nowhere else."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of places by rank; ``first`` finds the smallest rank that has any through three levels of 64-bit words."""

    def __init__(self, size: int):
        words = -(-size // 64)
        self.low = [0] * words
        self.mid = [0] * -(-words // 64)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(place)
            return
        self.buckets[rank] = [place]
        a, b = rank >> 6, rank >> 12
        self.low[a] |= 1 << (rank & 63)
        self.mid[b] |= 1 << (a & 63)
        self.top |= 1 << b

    def first(self) -> int:
        """The smallest rank, -1 if there is none."""
        top = self.top
        if not top:
            return -1
        b = (top & -top).bit_length() - 1
        m = self.mid[b]
        a = (b << 6) | (m & -m).bit_length() - 1
        w = self.low[a]
        return (a << 6) | (w & -w).bit_length() - 1

    def pop(self, rank: int) -> list[int]:
        """All places of a rank from left to right."""
        a, b = rank >> 6, rank >> 12
        self.low[a] ^= 1 << (rank & 63)
        if not self.low[a]:
            self.mid[b] ^= 1 << (a & 63)
            if not self.mid[b]:
                self.top ^= 1 << b
        out = self.buckets.pop(rank)
        out.sort()
        return out


class Encoder:
    def __init__(self, vocabulary: dict[bytes, int], pattern: str = PATTERN):
        self.rank = vocabulary
        self.size = max(vocabulary.values()) + 1
        self.pieces = regex.compile(pattern).findall
        self.byte = [vocabulary[bytes([i])] for i in range(256)]
        self.bytes_of = {v: k for k, v in vocabulary.items()}
        self.queue = RankQueue(self.size)
        self.pair: dict[int, int] = {}
        self.seen: dict[str, list[int]] = {}

    def _pair(self, a: int, b: int) -> int:
        """The rank of the merge of two symbols, -1 if there is none."""
        key = a * self.size + b
        got = self.pair.get(key)
        if got is None:
            got = self.rank.get(self.bytes_of[a] + self.bytes_of[b], -1)
            if len(self.pair) < PAIRS:
                self.pair[key] = got
        return got

    def merged(self, data: bytes) -> list[int]:
        """The ids of one pre-token's bytes."""
        n = len(data)
        symbol = [self.byte[c] for c in data]
        if n < 2:
            return symbol
        queue, pair = self.queue, self._pair
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (r := pair(symbol[i], symbol[i + 1])) >= 0:
                queue.push(r, i)
        while (rank := queue.first()) >= 0:
            places = queue.pop(rank)
            for at, i in enumerate(places):
                j = after[i]
                if symbol[i] < 0 or j >= n or pair(symbol[i], symbol[j]) != rank:
                    continue  # stale
                symbol[i], symbol[j] = rank, -1
                k = after[i] = after[j]
                lower = False
                if k < n:
                    before[k] = i
                    if (r := pair(rank, symbol[k])) >= 0:
                        queue.push(r, i)
                        lower = r <= rank
                h = before[i]
                if h >= 0 and (r := pair(symbol[h], rank)) >= 0:
                    queue.push(r, h)
                    lower = lower or r <= rank
                if lower:  # in no ordinary vocabulary: a merge of what was just made comes first
                    for p in places[at + 1 :]:
                        queue.push(rank, p)
                    break
        return [s for s in symbol if s >= 0]

    def piece(self, text: str) -> list[int]:
        data = text.encode()
        whole = self.rank.get(data)
        out = [whole] if whole is not None else self.merged(data)
        if len(text) <= SHORT and len(self.seen) < REMEMBERED:
            self.seen[text] = out
        return out

    def encode(self, text: str) -> list[int]:
        get, piece = self.seen.get, self.piece
        out: list[int] = []
        for p in self.pieces(text):
            out += get(p) or piece(p)
        return out


def encoded(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """``<id>, ids``: one row per row of ``docs``. The empty text has no ids, the null text has null; the strings of special tokens are ordinary text."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, pattern))
    kind = docs.schema[id_column].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # bounded by rows and, within, by one text
                b = batch.slice(at, 512)
                flat: list[int] = []
                ends = [0]
                missing = []
                for t in b.column(1).to_pylist():
                    if t:
                        flat += encoder.encode(t)
                    missing.append(t is None)
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)), mask=pa.array(missing))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], [id_column, "ids"])

    return docs.select(id_column, text).mapInArrow(encode, f"`{id_column}` {kind}, ids array<int>")
