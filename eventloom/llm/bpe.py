"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eventloom.llm.units import UnitCoder

#: Pre-tokens kept with their ids in each Python worker (the first ones met), and the longest one kept.
CACHE_TOKENS, CACHE_CHARS = 400_000, 48


class Bpe:
    """Encoder and decoder for one vocabulary of ranks (bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.pieces[i] = b
        self.pairs = [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]
        self.pattern = regex.compile(pattern)
        self.by_token: dict[str, bytes] = {}
        self.coder = UnitCoder(lambda units: [b"".join([self._token(m) for m in self.pattern.findall(u.decode())]) for u in units])

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token.

        The queue: `bucket` has, for each rank, the positions (left parts of a pair) that may merge under
        it; a bitmap of the ranks with a bucket stands in words of 256 bits, `words`, and `top` has a bit
        for each word in use.  Find-first-set on `top`, then on the word, is the least rank, whatever the
        queue holds.  A linked list (`ends`, `before`) holds the parts.  An entry is stale, and skipped,
        when the pair that now begins there has another rank or nothing begins there.  All entries of the
        least rank are taken left to right, as repeated scanning would take them; where a merge gives a
        pair of lower rank, what is left of the bucket goes back to the queue.  `now` has the rank of the
        pair that begins at each position, -1 for none.
        """
        rank_of = self.ranks.get
        whole = rank_of(token)
        if whole is not None:
            return [whole]
        n = len(token)
        ends = list(range(1, n + 1))  # end of the part that begins here
        before = list(range(-1, n - 1))
        pairs = self.pairs
        now = [pairs[a][b] for a, b in zip(token, token[1:])]  # noqa: B905
        now.append(-1)
        bucket: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        top = 0
        fresh = [i for i in range(n - 1) if now[i] >= 0]
        while True:
            for i in fresh:
                r = now[i]
                if r < 0:
                    continue
                if r in bucket:
                    bucket[r].append(i)
                else:
                    bucket[r] = [i]
                    w = r >> 8
                    words[w] = words.get(w, 0) | 1 << (r & 255)
                    top |= 1 << w
            if not top:
                break
            w = (top & -top).bit_length() - 1
            bits = words[w]
            rank = w << 8 | (bits & -bits).bit_length() - 1
            bits &= bits - 1
            words[w] = bits
            if not bits:
                top &= top - 1
            positions = bucket.pop(rank)
            if len(positions) > 1:
                positions.sort()
            fresh = []
            lower = False
            for i in positions:
                if now[i] != rank:
                    continue
                if lower:
                    fresh.append(i)
                    continue
                mid = ends[i]
                ends[i] = end = ends[mid]
                now[mid] = -1
                if end < n:
                    before[end] = i
                    now[i] = new = rank_of(token[i : ends[end]], -1)
                    if new >= 0:
                        fresh.append(i)
                        lower = new < rank
                else:
                    now[i] = -1
                left = before[i]
                if left >= 0:
                    now[left] = new = rank_of(token[left:end], -1)
                    if new >= 0:
                        fresh.append(left)
                        if new < rank:
                            lower = True
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(token[i : ends[i]]))
            i = ends[i]
        return ids

    def _token(self, token: str) -> bytes:
        ids = self.by_token.get(token)
        if ids is None:
            ids = np.array(self.merge(token.encode()), "<u4").tobytes()
            if len(token) <= CACHE_CHARS and len(self.by_token) < CACHE_TOKENS:
                self.by_token[token] = ids
        return ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; null counts as empty."""
        return [ids for _, ids in self.coder.column(texts)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I").tolist()))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def _bpe(path: str, pattern: str) -> Bpe:
    """One in each Python worker."""
    return Bpe(load_ranks(path), pattern)


def _mapped(df: DataFrame, f: Callable[[pa.RecordBatch], pa.Array], column: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, f(batch)], [*batch.schema.names, column])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)
    return df.mapInArrow(run, f"{fields}, `{column}` {kind}")


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds the ids of each whole text (binary, little-endian unsigned 32-bit); null counts as empty.

    `vocabulary` is the path of a rank file that every executor has.  No shuffle; memory follows the
    longest text.  An existing column named `to` is replaced.
    """
    def ids(batch: pa.RecordBatch) -> pa.Array:
        bpe = _bpe(vocabulary, pattern)
        return pa.array(bpe.encode(batch.column(batch.schema.names.index(text))), pa.binary())

    return _mapped(df.drop(to), ids, to, "binary")


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", to: str = "bytes") -> DataFrame:
    """Adds the bytes that the ids stand for; null ids give empty bytes, an unknown id raises."""
    def data(batch: pa.RecordBatch) -> pa.Array:
        bpe = _bpe(vocabulary, pattern)
        return pa.array([bpe.decode(x or b"") for x in batch.column(batch.schema.names.index(ids)).to_pylist()], pa.binary())

    return _mapped(df.drop(to), data, to, "binary")

