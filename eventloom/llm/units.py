"""Encoding texts by their units: each distinct unit of a block of texts is encoded once.

A unit is a run of white space with the other characters after it.  Pre-tokens of the usual byte-level
patterns never cross from one unit to the next, nor do their look-aheads, so a unit's ids are the same
wherever it stands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from eventloom.llm import kernels as K

#: Units kept with their ids in each Python worker, unless told otherwise (the first ones met: the frequent
#: ones are among them), the longest one kept, and how much text is taken at a time, in bytes.
CACHE_UNITS, CACHE_BYTES, BLOCK = 200_000, 64, 1 << 20
_WORD = np.array([chr(x).isalnum() and x < 128 for x in range(256)])
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_spans(part: K.Texts, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units, and the index of each row's first (one more than rows).

    A unit begins with ASCII white space after a character that is surely no white space: ASCII, or one
    whose lead byte no Unicode space has.  Elsewhere units just go on, which is always right.  cuts (a flag a
    byte) begin units too, after ASCII letters and digits: a word then is one unit, whatever stop follows it.
    """
    buf, offsets = part.buf, part.offsets
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = _SPACE[buf]
    plain = (buf < 0x80) & ~space
    sure = plain.copy()  # the character that ends at this byte is no white space
    tail = (buf & 0xC0) == 0x80
    two, three = buf[:-1], buf[:-2]
    sure[1:] |= tail[1:] & (two >= 0xC3) & (two < 0xE0)
    sure[2:] |= tail[2:] & tail[1:-1] & (three >= 0xE4) & (three < 0xF0)
    sure[3:] |= tail[3:] & (buf[:-3] >= 0xF0)
    begins = np.zeros(n + 1, bool)
    begins[1:-1] = space[1:] & sure[:-1]
    if cuts is not None:
        begins[1:-1] |= cuts[buf[1:]] & _WORD[buf[:-1]]
    begins[offsets] = True
    starts = np.flatnonzero(begins[:-1])
    return starts, np.append(starts[1:], n), np.searchsorted(starts, offsets)


class UnitCoder:
    """Encodes columns of texts by an encoder of distinct units (UTF-8; their ids as unsigned 32-bit integers)."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], cache_units: int = CACHE_UNITS, cuts: np.ndarray | None = None):
        self.encode, self.cache_units, self.cuts = encode, cache_units, cuts
        self.known: dict[bytes, bytes] = {}

    def _ids(self, keys: list[bytes]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, keys))
        holes = [i for i, x in enumerate(found) if x is None]
        if holes:
            for i, ids in zip(holes, self.encode([keys[i] for i in holes]), strict=True):
                found[i] = ids
                if len(keys[i]) <= CACHE_BYTES and len(known) < self.cache_units:
                    known[keys[i]] = ids
        return found

    def column(self, column: pa.Array | pa.ChunkedArray, end: bytes = b"") -> Iterator[tuple[int, bytes]]:
        """(row, ids and `end`) of each text, in order; null counts as empty."""
        for part in K.blocks(column, BLOCK):
            starts, ends, first = unit_spans(part, self.cuts)
            at, inverse = K.classes(part.buf, starts, ends)
            raw = part.buf.tobytes()
            ids = self._ids([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            table = np.frombuffer(b"".join(ids), "<u4")
            own = counts[inverse]
            stop = np.cumsum(own)
            shift = (np.cumsum(counts) - counts)[inverse] - (stop - own)
            out = table[np.repeat(shift, own) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes() if len(own) else b""
            bounds = (4 * np.concatenate([[0], stop])[first]).tolist()
            for i in range(len(part)):
                yield part.first + i, out[bounds[i] : bounds[i + 1]] + end
