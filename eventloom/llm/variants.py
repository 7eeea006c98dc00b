"""Spelling variants: near words found by probing generated edits against Bloom filters."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.tables import Scratch

U64 = np.uint64
#: Words of LONGEST code points or more share a shard.  Bits of a filter for each word, bits set for it, cells of an
#: array of edits at most (or one word's), and bytes of the filters that are broadcast at once.
LONGEST, BITS, PROBES, CELLS, FILTER_BYTES = 64, 16, 5, 1 << 19, 32 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = K.mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def runs(part: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The maximal runs of A-Z, a-z and U+00C0 to U+00FF: starts, ends, rows, code points."""
    low = part.buf | 32
    letter = (low >= 97) & (low <= 122)
    lead = part.buf == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    starts, ends, first = K._spans(part.buf, ~letter, part.offsets)
    leads = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, np.repeat(np.arange(len(part)), np.diff(first)), ends - starts - (leads[ends] - leads[starts])


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 7, every: int = 31, min_n: int = 2) -> DataFrame:
    """(word, n): the runs of all texts, lower-cased (A-Z), in some documents with a letter less, of `least` code points
    or more, `min_n` times or more.

    Let h be the crc32 of '<key>:<run>'; where `every` divides h, the run's code point h % length is left out.
    A null key is written as nothing; null and empty texts have no words.  Tasks count by block before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for part in K.blocks(batch.column(1), 1 << 21):
                starts, ends, row, size = runs(part)
                long = size >= least
                starts, ends, row = starts[long], ends[long], row[long]
                low = K.LOWER[part.buf]
                at, which = K.classes(low, starts, ends)
                raw = low.tobytes()
                words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                n = np.bincount(which, minlength=len(at))
                pairs, times = np.unique(row * max(1, len(at)) + which, return_counts=True)
                rows, kinds = np.divmod(pairs, max(1, len(at)))
                begin = [zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys[part.first : part.first + len(part)]]
                crc = zlib.crc32
                hashes = np.array([crc(words[k], begin[r]) for r, k in zip(rows.tolist(), kinds.tolist(), strict=True)], np.int64)
                other: Counter[str] = Counter()
                for i in np.flatnonzero(hashes % every == 0).tolist():
                    word = words[kinds[i]].decode()
                    k = int(hashes[i]) % len(word)
                    other[word[:k] + word[k + 1 :]] += int(times[i])
                    n[kinds[i]] -= times[i]
                kept = np.flatnonzero(n).tolist()
                short = [(w, c) for w, c in other.items() if len(w) >= least]
                yield pa.RecordBatch.from_arrays([pa.array([*[words[k].decode() for k in kept], *[w for w, _ in short]], pa.string()), pa.array([*n[kept].tolist(), *[c for _, c in short]], pa.int64())], ["word", "n"])

    counted = df.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_n)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of a table of code points (all below 256)."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def sums(table: np.ndarray) -> np.ndarray:
    """What a word's letters add to its hash, by place."""
    return _VALUE[table] * _powers(table.shape[1])


def finish(total: np.ndarray, length: int) -> np.ndarray:
    return K.mix(total + U64(length * _INVERSE % (1 << 64)))


def deletions(table: np.ndarray) -> np.ndarray:
    """Hashes of each word without each of its letters, by word and place."""
    part = sums(table)
    upto = np.cumsum(part, axis=1)
    return finish(upto - part + (upto[:, -1:] - upto) * U64(_INVERSE), table.shape[1] - 1)


def replacements(table: np.ndarray, letter: int) -> np.ndarray:
    """Hashes of each word with `letter` in each place."""
    part = sums(table)
    return finish(part.sum(axis=1, dtype=U64)[:, None] - part + _VALUE[letter] * _powers(table.shape[1]), table.shape[1])


class Filter:
    """A blocked Bloom filter: a key's bits all lie in one 64-bit block.  `part` of `parts`: the keys it is for."""

    def __init__(self, blocks: np.ndarray, part: int = 0, parts: int = 1):
        self.blocks, self.part, self.parts = blocks, part, parts

    @staticmethod
    def place(hashes: np.ndarray, n: int) -> np.ndarray:
        return ((hashes >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)

    @staticmethod
    def bits(hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), U64)
        for k in range(PROBES):
            out |= U64(1) << (hashes >> U64(6 * k) & U64(63))
        return out

    @staticmethod
    def split(hashes: np.ndarray, parts: int) -> np.ndarray:
        return K.mix(hashes) % U64(parts)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which places of the flat `hashes` may be keys: one bit is looked at, then the others of those that have it."""
        block = self.blocks[self.place(hashes, len(self.blocks))]
        at = np.flatnonzero(block >> (hashes & U64(63)) & U64(1))
        mask = self.bits(hashes[at])
        at = at[(block[at] & mask) == mask]
        return at if self.parts == 1 else at[self.split(hashes[at], self.parts) == U64(self.part)]


def shard(length: int) -> int:
    return min(length, LONGEST)


def by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """(length, places) of the words, in lists of CELLS letters at most, or one word."""
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(len(w), []).append(i)
    for length, own in places.items():
        step = max(1, CELLS // length)
        for k in range(0, len(own), step):
            yield length, own[k : k + step]


def plan_rounds(counts: dict[int, int], filter_bytes: int) -> list[list[tuple[int, int, int, int]]]:
    """Rounds of filters (shard, part, parts, blocks) of `filter_bytes` at most together; a shard whose filter would be
    larger is cut into parts."""
    rounds: list[list[tuple[int, int, int, int]]] = [[]]
    room = most = max(64, filter_bytes) // 8
    for s, n in sorted(counts.items()):
        parts = -(-n * BITS // 64 // most) or 1
        blocks = min(most, n * BITS // 64 // parts + 64)
        for part in range(parts):
            if blocks > room:
                rounds.append([])
                room = most
            rounds[-1].append((s, part, parts, blocks))
            room -= blocks
    return [r for r in rounds if r]


def near_pairs(words: DataFrame, scratch: Scratch, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words that differ by one inserted, deleted or replaced code point.

    words: (word, n), a written table of distinct words of code points below 256.  Each word's deletions are
    probed in the filter of the length below (which finds insertions too, from the other side), its replacements by
    higher letters in that of its own.  Filters are built by tasks and merged by aggregation; those broadcast at
    once have `filter_bytes` at most, whatever the number of words: more words mean more rounds.  What the filters
    let pass meets the vocabulary in a shuffled join, which removes the false ones.
    """
    spark = words.sparkSession
    sized = words.select("word", "n", F.least(F.length("word"), F.lit(LONGEST)).alias("shard"))
    counts = {r["shard"]: r["n"] for r in sized.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # LONGEST rows at most
    alphabet = sorted(ord(r[0]) for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect())  # 256 at most
    found = []
    for filters in plan_rounds(counts, filter_bytes):
        held = spark.sparkContext.broadcast(_built(sized, filters))
        of = sorted({s for s, *_ in filters} | {s + 1 for s, *_ in filters})
        probing = sized.where(F.col("shard").isin(*of)).select("word", "n")
        found.append(scratch.written(probing.mapInArrow(_prober(held, alphabet), "word string, n long, near string")))
        held.unpersist()
    if not found:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    positives = found[0]
    for more in found[1:]:
        positives = positives.union(more)
    pairs = scratch.written(positives.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n"))
    scratch.drop(*found)
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def _built(sized: DataFrame, filters: list[tuple[int, int, int, int]]) -> list[tuple[int, Filter]]:
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, own in by_length(words):
                hashes = finish(sums(letters([words[i] for i in own])).sum(axis=1, dtype=U64), length)
                for i, (s, part, parts, blocks) in enumerate(filters):
                    if s != shard(length):
                        continue
                    mine = hashes if parts == 1 else hashes[Filter.split(hashes, parts) == U64(part)]
                    at, inverse = np.unique(Filter.place(mine, blocks), return_inverse=True)
                    mask = np.zeros(len(at), U64)
                    np.bitwise_or.at(mask, inverse, Filter.bits(mine))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(at), pa.array(mask.view(np.int64))], ["filter", "block", "mask"])

    rows = sized.where(F.col("shard").isin(*{s for s, *_ in filters})).select("word").mapInArrow(fill, "filter int, block long, mask long")
    table = rows.groupBy("filter", "block").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    kind, block, mask = (table[c].to_numpy() for c in ("filter", "block", "mask"))
    out = []
    for i, (s, part, parts, blocks) in enumerate(filters):
        own, bits = kind == i, np.zeros(blocks, U64)
        bits[block[own]] = mask[own].view(U64)
        out.append((s, Filter(bits, part, parts)))
    return out


def _prober(held: Broadcast, alphabet: list[int]):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, list[Filter]] = {}
        for s, x in held.value:
            filters.setdefault(s, []).append(x)
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1)
            for length, own in by_length(words):
                table = letters([words[i] for i in own])
                at, near = [], []
                if (below := filters.get(shard(length - 1))) and length > 1:
                    new = np.ones(table.shape, bool)  # of equal letters side by side, one deletion is enough
                    new[:, 1:] = table[:, 1:] != table[:, :-1]
                    cells = np.flatnonzero(new)
                    hashes = deletions(table).ravel()[cells]
                    for x in below:
                        row, place = np.divmod(cells[x.holds(hashes)], length)
                        left = np.arange(length - 1) + (np.arange(length - 1) >= place[:, None])
                        at.append(row)
                        near += _texts(np.take_along_axis(table[row], left, axis=1))
                if same := filters.get(shard(length)):
                    for letter in alphabet:
                        cells = np.flatnonzero(table < letter)
                        if not len(cells):
                            continue
                        hashes = replacements(table, letter).ravel()[cells]
                        for x in same:
                            row, place = np.divmod(cells[x.holds(hashes)], length)
                            changed = table[row]
                            changed[np.arange(len(row)), place] = letter
                            at.append(row)
                            near += _texts(changed)
                rows = pa.array(np.array(own, np.int64)[np.concatenate(at)] if at else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), n.take(rows), pa.array(near, pa.string())], ["word", "n", "near"])

    return probe


def _texts(table: np.ndarray) -> list[str]:
    n, text = table.shape[1], table.tobytes().decode("latin-1")
    return [text[i : i + n] for i in range(0, len(text), n)]


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): where following forms (word, form) ends.  Each round a word takes its target's target; forms grow
    tenfold in number, so chains are short and rounds few."""
    ends = scratch.written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = scratch.written(ends.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(ends)
        ends = new
        if new.where("moved").isEmpty():
            return new.select("word", "root")


def variants(words: DataFrame, times: int = 10, scratch: Scratch | None = None, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word: how many words are near it, its form (the near word of
    largest n, ties to the smallest in code-point order, where that n is `times` the word's or more), and the
    last of the forms from it on (the word itself without one).

    words: (word, n), distinct words of code points below 256; no other columns play a part.  An empty table gives
    no rows; null words aren't words and are left out; a word has at most as many near words as edits, so no key is hot.
    """
    scratch = scratch or Scratch(words.sparkSession)
    words = scratch.written(words.select("word", "n").where("word is not null"))
    pairs = near_pairs(words, scratch, filter_bytes)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near"))).alias("_b"))
    enough = F.col("_b.near_n") >= times * F.col("n")
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("_b.near")).alias("form"), F.when(enough, F.col("_b.near_n")).alias("form_n"))
    out = scratch.written(out)
    return out.join(roots(out.where("form is not null"), scratch), "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_spellings(df: DataFrame, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Spelling variants among the words of all texts: `vocabulary`, then `variants`."""
    return variants(vocabulary(df, key, text), scratch=scratch)
