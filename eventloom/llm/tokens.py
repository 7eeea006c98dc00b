"""Token ids of the tokenizers library, each distinct unit of text encoded once a block."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from eventloom.llm.units import UnitCoder

#: Bytes that begin a unit as white space, ASCII bytes that end it as something else; units encoded in one call.
_LEADS = frozenset(bytes([x]) for x in b" \t\n\v\f\r")
_PLAIN = frozenset(bytes([x]) for x in range(33, 127))
_JOIN = 200


@functools.cache
def coder(path: str) -> UnitCoder:
    """One in each Python worker; for byte-level BPE vocabularies whose special tokens hold no white space.
    Their strings in a text give their ids, as the library does by itself."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    width = np.zeros(tokenizer.get_vocab_size(), np.int64)  # bytes of each token: a byte-level token has a letter for each
    for token, i in tokenizer.get_vocab().items():
        width[i] = len(token)

    def encode(units: list[bytes]) -> list[bytes]:
        """Units that begin with white space and end in something else stay apart when joined, so one call
        encodes them all; their lengths in bytes tell where each one's ids end.  Others, which begin or end
        texts, go one by one: white space at a unit's end would run on into the next unit."""
        out: list[bytes] = [b""] * len(units)
        apart = [u[:1] in _LEADS and (u[-1:] in _PLAIN or not u.decode()[-1:].isspace()) for u in units]
        joined = [i for i, x in enumerate(apart) if x]
        alone = [i for i, x in enumerate(apart) if not x]
        for i, e in zip(alone, tokenizer.encode_batch_fast([units[i].decode() for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        for first in range(0, len(joined), _JOIN):
            part = joined[first : first + _JOIN]
            own = [units[i] for i in part]
            ids = np.array(tokenizer.encode_batch_fast([b"".join(own).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(u) for u in own])
            reach = np.cumsum(width[ids])
            cut = np.searchsorted(reach, ends)
            if cut[-1] >= len(ids) or (reach[cut] != ends).any():
                raise ValueError("a token crosses from one unit to the next")
            raw, last = ids.tobytes(), 0
            for i, end in zip(part, (4 * (cut + 1)).tolist(), strict=True):
                out[i] = raw[last:end]
                last = end
        return out

    # A letter and a stop after it are never in one pre-token; a special token may hold both.
    special = "".join(str(x.content) for x in tokenizer.get_added_tokens_decoder().values())
    cuts = np.zeros(256, bool)
    cuts[[ord(c) for c in ".,;:!?" if c not in special]] = True
    return UnitCoder(encode, cache_units=600_000, cuts=cuts)


def encoded(column: pa.Array, path: str, end: int) -> Iterator[tuple[int, bytes]]:
    """(row, ids as little-endian unsigned 32-bit integers, `end` last) of a batch's texts; null counts as empty."""
    return coder(path).column(column, np.array([end], "<u4").tobytes())
