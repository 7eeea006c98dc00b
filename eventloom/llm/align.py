"""Cross-tokenizer alignment: token groups, links and their corpus-wide counts, merged in lockstep."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from eventloom.llm import kernels as K
from eventloom.llm.tables import Scratch, short_batches
from eventloom.llm.units import unit_spans

#: Units kept with their alignment in each Python worker, the longest one kept, and how much text is taken at a time, in bytes.
CACHE_UNITS, CACHE_BYTES, BLOCK = 150_000, 64, 1 << 20


def lockstep(a: np.ndarray, a_first: np.ndarray, b: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that end together, (places in a, places in b), in order.

    a, b: bytes of each token, lane after lane; *_first: where each lane's tokens begin (one more than lanes).  Both
    sides of a lane have as many bytes, none of no tokens.  One state vector holds a pointer into either side for
    every lane; each step compares where the tokens pointed at end, emits those that end together, moves the
    pointer that is behind (both, at a cut), and drops the lanes that have come to their end.
    """
    end_a, end_b = np.cumsum(a), np.cumsum(b)  # over all lanes: a lane's sides begin at the same byte
    i, j, stop = a_first[:-1].copy(), b_first[:-1].copy(), a_first[1:]
    at_a, at_b = [], []
    while len(i):
        x, y = end_a[i], end_b[j]
        cut = x == y
        at_a.append(i[cut])
        at_b.append(j[cut])
        i, j = i + (x <= y), j + (y <= x)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    left, right = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (at_a, at_b))
    order = np.argsort(left)
    return left[order], right[order]


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others are counted from 256."""
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    others = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(others)}


class Aligner:
    """Two vocabularies: A a byte-level BPE file of the tokenizers library, B a sentencepiece model that writes spaces as U+2581.

    Tokens of both end where a unit ends (see `units`), so units are aligned each for itself: the lanes of the
    lockstep are the different units of a batch's documents, however long a document is.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for p in pieces:
            if re.search("[^▁]▁", p) or (len(p) > 1 and re.search(r"[\t\n\v\f ]", p)):
                raise ValueError(f"piece {p!r} goes over the end of a unit")
        hexadecimal = re.compile("<0x([0-9A-F]{2})>")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := hexadecimal.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.space = self.b.piece_to_id("▁")
        self.a_size, self.b_size = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.pairs = self._pairs()
        self.known: dict[bytes, tuple] = {}

    def _pairs(self) -> np.ndarray:
        """Every (A id, B id), as A id * |B| + B id, sorted, whose tokens can end together: one's bytes end the other's.

        The vocabularies alone bound them, by the sum of their tokens' lengths times what equal tokens they have."""
        def of(tokens: list[bytes]) -> dict[bytes, list[int]]:
            found = defaultdict(list)
            for i, x in enumerate(tokens):
                if x:
                    found[x].append(i)
            return found

        a, b, n = of(self.a_bytes), of(self.b_bytes), len(self.b_bytes)
        found = {i * n + j for x, ids in a.items() for k in range(len(x)) for j in b.get(x[k:], ()) for i in ids}
        found |= {i * n + j for x, ids in b.items() for k in range(len(x)) for i in a.get(x[k:], ()) for j in ids}
        return np.array(sorted(found), np.int64)

    def pair_b(self) -> np.ndarray:
        """The B id of each pair."""
        return self.pairs % len(self.b_bytes)

    def _encode_b(self, units: list[str]) -> list[list[int]]:
        """The library puts a space before each text: it stands for a unit's own, or its piece is taken off."""
        own = [u[0] == " " for u in units]
        found = self.b.encode([u[1:] if x else u for u, x in zip(units, own, strict=True)], num_threads=1)
        return [([self.space] if u == " " else ids) if x else ids[1:] for u, x, ids in zip(units, own, found, strict=True)]

    def _align(self, units: list[bytes]) -> list[tuple]:
        """(groups as text, A tokens, B tokens, groups, pairs of the links) of each unit; None where bytes differ."""
        texts = [u.decode() for u in units]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self._encode_b(texts)
        out: list[tuple | None] = [None] * len(units)
        good = [k for k, u in enumerate(units) if b"".join([self.a_bytes[i] for i in ids_a[k]]) == u == b"".join([self.b_bytes[i] for i in ids_b[k]])]
        if not good:
            return out
        sides = [(np.array([i for k in good for i in ids[k]], np.int64), np.cumsum([0, *[len(ids[k]) for k in good]])) for ids in (ids_a, ids_b)]
        (a, a_first), (b, b_first) = sides
        p, q = lockstep(self.a_size[a], a_first, self.b_size[b], b_first)
        links = np.searchsorted(self.pairs, a[p] * len(self.b_bytes) + b[q]).astype("<i4")
        text_a, text_b = [str(x) for x in a.tolist()], [str(x) for x in b.tolist()]
        groups, x, y = [], 0, 0
        for i, j in zip((p + 1).tolist(), (q + 1).tolist(), strict=True):
            groups.append(",".join(text_a[x:i]) + "|" + ",".join(text_b[y:j]))
            x, y = i, j
        first = np.searchsorted(p, a_first).tolist()
        for n, k in enumerate(good):
            lo, hi = first[n], first[n + 1]
            out[k] = (";".join(groups[lo:hi]).encode(), len(ids_a[k]), len(ids_b[k]), hi - lo, links[lo:hi].tobytes())
        return out

    def of(self, keys: list[bytes]) -> list[tuple | None]:
        known = self.known
        holes = [i for i, k in enumerate(keys) if k not in known]
        found = [known.get(k) for k in keys]
        for i, x in zip(holes, self._align([keys[i] for i in holes]) if holes else [], strict=True):
            found[i] = x
            if len(keys[i]) <= CACHE_BYTES and len(known) < CACHE_UNITS:
                known[keys[i]] = x
        return found


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One in each Python worker."""
    return Aligner(a_path, b_path)


def units(part: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units, and the index of each row's first (one more than rows): pieces of B may hold a
    carriage return after other characters, so none is cut before one."""
    starts, _, _ = unit_spans(part)
    starts = starts[part.buf[starts] != 13]
    return starts, np.append(starts[1:], len(part.buf)), np.searchsorted(starts, part.offsets)


_FIELDS = "_doc long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pair int, n long"
_NAMES = [x.split()[0] for x in _FIELDS.split(", ")]


def align(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row.

    A encodes a space and the text, B the text, which it puts a space before.  Byte offsets where tokens of both end
    cut the tokens into groups; the two tokens that end there are linked.  A pair's count is how many links it has
    in the corpus; a link is best if no other A id has a higher count with its B id.

    1. One pass encodes, merges in lockstep, and writes each row's digest and the places of its links in the list of
       possible pairs; each task adds up its counts by pair.
    2. Counts are summed by pair.  They are at most as many as the pairs whose tokens can end together, which the
       vocabularies bound (324,302 for the two of the query) however large the corpus is, so they are broadcast.
    3. A second pass over the written links looks them up.

    Null and empty texts, and those whose tokens don't give their bytes back, have no tokens: zeros, and '' for the
    digest.  Null keys and repeated rows are rows like others (and count as often as they stand there); ties in
    a count are all best; an empty table gives no rows; other columns play no part.
    """
    spark = df.sparkSession
    scratch = scratch or Scratch(spark)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_ids = aligner(a_path, b_path)
        total = np.zeros(len(with_ids.pairs), np.int64)
        for batch in batches:
            keys, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
            for part in K.blocks(spaced, BLOCK):
                starts, ends, first = units(part)
                at, which = K.classes(part.buf, starts, ends)
                raw = part.buf.tobytes()
                found = with_ids.of([raw[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
                row_of = np.repeat(np.arange(len(part)), np.diff(first))
                wrong = np.array([x is None for x in found])[which]
                ok = np.diff(part.offsets) > 1
                ok[row_of[wrong]] = False
                none = (b"", 0, 0, 0, b"")
                found = [x or none for x in found]
                numbers = np.array([x[1:4] for x in found], np.int64).reshape(-1, 3)
                sums = np.add.reduceat(numbers[which], first[:-1], axis=0) * ok[:, None]
                used = np.bincount(which[ok[row_of]], minlength=len(found))
                table = np.frombuffer(b"".join([x[4] for x in found]), "<i4")
                np.add.at(total, table, np.repeat(used, numbers[:, 2]))
                own = numbers[which, 2]
                stop = np.cumsum(own)
                shift = (np.cumsum(numbers[:, 2]) - numbers[:, 2])[which] - (stop - own)
                links = table[np.repeat(shift, own) + np.arange(int(stop[-1]))].tobytes()
                bounds = (4 * np.concatenate([[0], stop])[first]).tolist()
                groups, place, cut = [x[0] for x in found], which.tolist(), first.tolist()
                digests, lists = [], []
                for i, good in enumerate(ok.tolist()):
                    digests.append(hashlib.sha256(b";".join([groups[k] for k in place[cut[i] : cut[i + 1]]])).hexdigest() if good else "")
                    lists.append(links[bounds[i] : bounds[i + 1]] if good else b"")
                n = len(part)
                cells = [keys.slice(part.first, n).cast(pa.int64()), *(pa.array(sums[:, k]) for k in range(3)), pa.array(digests, pa.string()), pa.array(lists, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(cells, _NAMES)
        pairs = np.flatnonzero(total)
        n = len(pairs)
        cells = [*(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()), pa.array(pairs, pa.int32()), pa.array(total[pairs])]
        yield pa.RecordBatch.from_arrays(cells, _NAMES)

    with short_batches(spark):
        merged = scratch.written(df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(merge, _FIELDS))
    counted = merged.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    own = aligner(a_path, b_path)
    count, most = np.zeros(len(own.pairs), np.int64), np.zeros(len(own.b_bytes), np.int64)
    count[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    np.maximum.at(most, own.pair_b(), count)
    looked_up = spark.sparkContext.broadcast((count, count == most[own.pair_b()]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = looked_up.value
        for batch in batches:
            sums = []
            for links in batch.column(5).to_pylist():
                at = np.frombuffer(links, "<i4")
                sums.append((len(at), int(best[at].sum()), int(counts[at].sum())))
            cells = [pa.array(x, pa.int64()) for x in (zip(*sums, strict=True) if sums else ([], [], []))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), *cells, batch.column(4)], ["_doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    rows = merged.where("pair is null").select(*_NAMES[:6])
    with short_batches(spark):
        out = scratch.written(rows.mapInArrow(look_up, "_doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
    scratch.drop(merged)
    return out.withColumnRenamed("_doc", key)

