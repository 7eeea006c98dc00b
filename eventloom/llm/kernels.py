"""Word and line tables over the UTF-8 buffers of Arrow text columns.

Everything here runs inside a task on one batch of rows: numpy over bytes, no
per-word Python.  Words are ``[^\\x20\\x09-\\x0D]+``; the separators are ASCII,
so words can be cut on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BLOCK_BYTES = 1 << 19
_GOLDEN = 0x9E3779B97F4A7C15
_BASES = (_GOLDEN, 0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64's finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_VALUES = [mix(np.arange(1, 257, dtype=U64) * U64(_GOLDEN) + U64(k)) for k in range(2)]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """BASE**0 .. BASE**(n-1) modulo 2**64, or the same of BASE's inverse."""
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        have = np.full(max(n, BLOCK_BYTES + 1), base, dtype=U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[which, inverse] = have
    return have[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans hash alike wherever they lie, and so may others: `classes`
    tells them apart.

    A prefix sum of value(byte) * BASE**i gives any span's polynomial in two
    look-ups.  Work goes in blocks, so memory stays bounded for very long texts
    (a block holds one span at least).
    """
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        cum = np.zeros(hi - lo + 1, U64)
        np.cumsum(_VALUES[which][buf[lo:hi]] * _power(which, hi - lo), out=cum[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((cum[b] - cum[a]) * _power(which, hi - lo + 1, True)[a] + (b - a).astype(U64))
        i = j
    return out


def unequal(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Numbers of the spans whose bytes differ from those of the span numbered `of`."""
    size, other = ends - starts, starts[of]
    wrong = size != size[of]
    check = np.flatnonzero((other != starts) & ~wrong & (size > 0))
    stop = np.cumsum(size[check])
    found, i = [np.flatnonzero(wrong)], 0
    while i < len(check):
        j = max(i + 1, int(np.searchsorted(stop, (stop[i - 1] if i else 0) + BLOCK_BYTES, "right")))
        part = check[i:j]
        n = size[part]
        if len(part) == 1:
            a, b = int(starts[part[0]]), int(other[part[0]])
            if (buf[a : a + n[0]] != buf[b : b + n[0]]).any():
                found.append(part)
        else:
            end = np.cumsum(n)
            at = np.repeat(starts[part] - (end - n), n) + np.arange(end[-1])
            differ = buf[at] != buf[at + np.repeat(other[part] - starts[part], n)]
            if differ.any():
                found.append(part[np.unique(np.searchsorted(end, np.flatnonzero(differ), "right"))])
        i = j
    return np.concatenate(found)


def classes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(at, which): the number of one span of each content, and each span's place among these.  Spans are in
    one class if and only if their bytes are equal: hashes propose, the bytes decide."""
    _, at, which = np.unique(span_hashes(buf, starts, ends) if hashes is None else hashes, return_index=True, return_inverse=True)
    odd = unequal(buf, starts, ends, at[which])
    if len(odd):
        known: dict[bytes, int] = {}
        more = []
        for i in odd.tolist():
            content = buf[starts[i] : ends[i]].tobytes()
            if content not in known:
                known[content] = len(at) + len(more)
                more.append(i)
            which[i] = known[content]
        at = np.append(at, more)
    return at, which


def digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 128-bit digest (BLAKE2b) of each span's bytes, as two columns of unsigned 64-bit integers."""
    raw, blake = buf.tobytes(), hashlib.blake2b
    found = b"".join([blake(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(found, "<u8").reshape(-1, 2)


def joined(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes, each with one space after it, and where each begins there (one more than spans)."""
    size = ends - starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(begin[-1]), 32, np.uint8)
    if len(size):
        n = int(size.sum())
        inside = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(begin[:-1], size) + inside] = buf[np.repeat(starts, size) + inside]
    return out, begin


@dataclass
class Texts:
    """Consecutive rows of a text column: their bytes, and where each row begins."""

    first: int
    buf: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the index of each row's first word (one more than rows)."""
        return _spans(self.buf, SEPARATOR[self.buf], self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Starts and ends of all non-empty \n-split lines, and the index of each row's first."""
        return _spans(self.buf, self.buf == 10, self.offsets)


def _spans(buf: np.ndarray, cut: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begins = ~cut
    finish = begins.copy()
    begins[1:] &= cut[:-1] | edge[1:-1]
    finish[:-1] &= cut[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES, group: int = 1) -> Iterator[Texts]:
    """The column's rows, in order, in pieces of about `limit` bytes, each of a multiple of `group` rows (one
    group at least).  Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + group, j - (j - i) % group))
        yield Texts(i, buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j
    pa.default_memory_pool().release_unused()


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive hashes, by position; `len(hashes) - n + 1` of them."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    m = len(hashes) - n + 1
    out = np.zeros(m, U64)
    for k in range(n):
        out += hashes[k : k + m] * U64(pow(_BASES[1], k + 1, 1 << 64))
    return mix(out + U64(n))
