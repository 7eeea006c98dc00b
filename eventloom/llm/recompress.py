"""Substring dedup by recompression: rounds name runs and pairs of words, shared names reveal long repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.tables import Scratch, fields, join_frequent, with_lists

#: Rounds of naming.  Runs are named in the first RUN_ROUNDS of them, where names are short; the symbols
#: after WINDOW_ROUNDS stand for windows, those after all rounds (some 30 words each) cut rows into segments.
ROUNDS, WINDOW_ROUNDS, RUN_ROUNDS = 12, 7, 2
_FAR = 1 << 40


@dataclass
class Level:
    """Symbols of one round, in text order: names, and the words [left, right) that decide them.

    Wherever the words of [left, right) stand again, the same symbol stands at the same place in them.
    """

    name: np.ndarray
    start: np.ndarray
    left: np.ndarray
    right: np.ndarray
    row: np.ndarray


def _beside(level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether each symbol has a left (right) neighbour in its row, and how far that neighbour's context reaches."""
    same = level.row[1:] == level.row[:-1]
    has_left, has_right = np.concatenate([[False], same]), np.concatenate([same, [False]])
    left = np.where(has_left, np.concatenate([[0], level.left[:-1]]), -_FAR)
    right = np.where(has_right, np.concatenate([level.right[1:], [0]]), _FAR)
    return has_left, has_right, left, right


def name_runs(level: Level, salt: int) -> Level:
    """Each run of equal symbols becomes one, named by symbol and length.  Its ends, and that a single
    symbol is no run, are decided by the neighbours; a row's edge decides nothing elsewhere."""
    n = len(level.name)
    has_left, has_right, left, right = _beside(level)
    begins = ~has_left
    begins[1:] |= level.name[1:] != level.name[:-1]
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, n))
    last = at + length - 1
    name = np.where(length > 1, K.mix(level.name[at] + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(salt)), level.name[at])
    return Level(name, level.start[at], np.minimum(level.left[at], left[at]), np.maximum(level.right[last], right[last]), level.row[at])


def name_pairs(level: Level, salt: int) -> Level:
    """A bit of each name halves the alphabet; every (first half, second half) neighbour pair becomes one
    symbol named by both.  A pair is decided by itself; a symbol of the first half that stays single by
    its right neighbour, one of the second half by its left one."""
    n = len(level.name)
    has_left, has_right, left, right = _beside(level)
    second = (K.mix(level.name + np.uint64(salt)) >> np.uint64(17) & np.uint64(1)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = has_right[:-1] & ~second[:-1] & second[1:]
    absorbed = np.concatenate([[False], pair[:-1]])
    at = np.flatnonzero(~absorbed)
    is_pair = pair[at]
    other = np.minimum(at + 1, n - 1)
    merged = K.mix(level.name[at] * np.uint64(0x9FB21C651E98DF25) + (level.name[other] ^ np.uint64(salt)))
    single_left = np.where(second[at], left[at], level.left[at])
    single_right = np.where(second[at], level.right[at], right[at])
    return Level(
        np.where(is_pair, merged, level.name[at]),
        level.start[at],
        np.where(is_pair, level.left[at], np.minimum(single_left, level.left[at])),
        np.where(is_pair, level.right[other], np.maximum(single_right, level.right[at])),
        level.row[at],
    )


def levels(words: np.ndarray, row: np.ndarray) -> list[Level]:
    at = np.arange(len(words), dtype=np.int64)
    found = [Level(words, at, at, at + 1, row)]
    for k in range(ROUNDS):
        x = name_runs(found[-1], 2 * k + 1) if k < RUN_ROUNDS else found[-1]
        found.append(name_pairs(x, 2 * k + 2))
    return found


def window_symbols(found: list[Level], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of `window` words within rows, and one symbol's name for each.

    The symbol is the least name among those whose context lies in the window, at the highest level
    that has any; level 0, the words, always has.  It depends on the window's words alone, so equal
    windows have equal symbols, and a window without a shared symbol is nowhere repeated.
    """
    row = found[0].row
    n = len(row)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.flatnonzero(row[window - 1 :] == row[: n - window + 1])
    chosen = np.zeros(len(start), np.uint64)
    open_ = np.arange(len(start))
    for depth in range(WINDOW_ROUNDS, -1, -1):
        x = found[depth]
        if not len(open_):
            break
        fits = x.right - x.left <= window
        name, left, right = x.name[fits], x.left[fits], x.right[fits]
        lo = np.searchsorted(left, start[open_])
        hi = np.searchsorted(right, start[open_] + window, "right")
        some = hi > lo
        lo, hi, at = lo[some], hi[some], open_[some]
        if len(at):
            new = np.ones(len(at), bool)
            new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            lo, hi = lo[new], hi[new]
            least = name[lo].copy()
            for k in range(1, int((hi - lo).max())):
                more = np.flatnonzero(lo + k < hi)
                least[more] = np.minimum(least[more], name[lo[more] + k])
            chosen[at] = K.mix(least[np.cumsum(new) - 1] + np.uint64(depth))
        open_ = open_[~some]
    return start, chosen


class Words:
    """The words of some rows: each one's row, each row's first word, names (equal words have equal names, and so
    may others), and their bytes with single spaces."""

    def __init__(self, part: K.Texts):
        starts, ends, self.first = part.words()
        self.row = np.repeat(np.arange(len(part)), np.diff(self.first))
        self.name = K.span_hashes(part.buf, starts, ends)
        self.buf, self.begin = K.joined(part.buf, starts, ends)

    def digests(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words [a, b), from their bytes."""
        return K.digests(self.buf, self.begin[a], self.begin[b])


def _distinct(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(group):
        return group, value
    order = np.lexsort((value, group))
    group, value = group[order], value[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
    return group[new], value[new]


def segment_table(part: K.Texts, window: int) -> list[pa.Array]:
    """For each segment that a window starts in: row, first word and end of its windows' words (counted in
    the row), their digest, the symbols of its windows.  Segments begin where top-level symbols do."""
    words = Words(part)
    n, first = len(words.row), words.first
    found = levels(words.name, words.row) if n else []
    begin, own = (found[-1].start, found[-1].row) if found else (np.zeros(0, np.int64),) * 2
    stop = np.minimum(np.append(begin[1:], n) + window - 1, first[1:][own]) if len(begin) else begin
    stop = np.where(np.append(own[1:] == own[:-1], False), stop, first[1:][own]) if len(begin) else begin
    some = stop - begin >= window
    begin, stop, own = begin[some], stop[some], own[some]
    start, name = window_symbols(found, window) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    at, name = _distinct(np.searchsorted(begin, start, "right") - 1, name)
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, np.arange(len(begin) + 1)).astype(np.int32)), pa.array(name.view(np.int64)))
    base, digest = first[own] if len(own) else own, words.digests(begin, stop).view(np.int64)
    return [own, pa.array((begin - base).astype(np.int32)), pa.array((stop - base).astype(np.int32)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists]


def window_table(part: K.Texts, window: int, lists: pa.Array) -> list[pa.Array]:
    """For each different window (among those of one row) whose symbol is in the row's list: row, digest, first words."""
    words = Words(part)
    start, name = window_symbols(levels(words.name, words.row), window) if len(words.row) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    own = words.row[start]
    begin = np.searchsorted(own, np.arange(len(part) + 1))
    hit = np.zeros(len(start), bool)
    for i in range(len(part)):
        x = slice(begin[i], begin[i + 1])
        hit[x] = np.isin(name[x], lists[part.first + i].values.to_numpy().view(np.uint64))
    start, own = start[hit], own[hit]
    digest = words.digests(start, start + window).view(np.int64)
    order = np.lexsort((start, digest[:, 1], digest[:, 0], own))
    start, own, digest = start[order], own[order], digest[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (digest[1:] != digest[:-1]).any(axis=1)
    places = pa.ListArray.from_arrays(pa.array(np.append(np.flatnonzero(new), len(own)).astype(np.int32)), pa.array((start - words.first[own]).astype(np.int32)))
    return [own[new], pa.array(digest[new, 0]), pa.array(digest[new, 1]), places]


ADDED = "n_words long, n_removed long, kept_sha256 string"


def drop_repeats(df: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """Removes each word covered by a window of `window` words that also starts in a row of smaller key.

    1. Every row names its words, runs and pairs in rounds; a name is a function of what it stands for, the
       same all over the corpus, so equal passages get equal symbols except near their ends.  Top-level
       symbols cut rows into segments.  An aggregation gives each segment's (with the words of all
       windows that start in it) smallest key: elsewhere the segment is a repeat as a whole.
    2. What is left are borders of repeats, and first holders.  There each window is represented by one
       symbol inside it; symbols that two keys or more still have reveal windows that may repeat.
    3. Only those windows are digested; an aggregation gives each one's smallest key, which verifies the repeat.

    Names only propose.  What decides, for segments as for windows, are 128-bit digests (BLAKE2b) of the
    bytes of their words.  Windows are judged on the input, repeats within one row stay.  The row's words
    that stay are joined by one space where any was removed; other texts are not changed.  Adds n_words,
    n_removed and the SHA-256 of the kept words joined by one space (existing columns of these names are
    replaced; others may have any name).  Null and empty texts have no words; a null key comes before all
    others, rows that share a key never remove from each other; an empty table gives no rows.  Frequent
    segments and windows meet in partial aggregations and are broadcast; so no task gets all rows of one.
    Each table goes when the tables that are made of it are written; the result reads one list of spans a row.
    """
    scratch = scratch or Scratch(df.sparkSession)
    df = df.drop(*[c.split()[0] for c in ADDED.split(", ")])
    number = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    same = {"_doc": number, "_t": F.xxhash64(F.col(text))}  # tells rows of one key apart
    docs = df.select(*[c.alias(n) for n, c in same.items()], F.col(text).alias("_text"))
    several = [F.min("_doc").alias("_first"), F.count("*").alias("_n"), F.max("_doc").alias("_last")]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.blocks(batch.column(2)):
                own, *columns = segment_table(part, window)
                at = pa.array(part.first + own)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *columns], ["_doc", "_t", "_at", "_to", "_a", "_b", "_names"])

    cut = scratch.written(docs.mapInArrow(segments, "_doc long, _t long, _at int, _to int, _a long, _b long, _names array<long>"))
    owner = scratch.written(cut.groupBy("_a", "_b").agg(*several).where("_first <> _last").select("_a", "_b", "_first", "_n"))
    again = join_frequent(cut.drop("_names"), owner, ["_a", "_b"], "_n").where("_first < _doc").select("_doc", "_t", "_at", "_to")
    again = scratch.written(again)
    names = cut.join(again, ["_doc", "_t", "_at"], "left_anti").select("_doc", "_t", F.explode("_names").alias("_name"))
    names = scratch.written(names.distinct())
    scratch.drop(cut, owner)
    shared = scratch.written(names.groupBy("_name").agg(*several).where("_first <> _last").select("_name", "_n"))
    marked = scratch.written(join_frequent(names, shared, ["_name"], "_n").groupBy("_doc", "_t").agg(F.collect_set("_name").alias("_names")))
    scratch.drop(names, shared)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.blocks(batch.column(2)):
                own, *columns = window_table(part, window, batch.column(3))
                at = pa.array(part.first + own)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *columns], ["_doc", "_t", "_a", "_b", "_at"])

    seen = scratch.written(docs.join(marked, ["_doc", "_t"]).select("_doc", "_t", "_text", "_names").mapInArrow(windows, "_doc long, _t long, _a long, _b long, _at array<int>"))
    scratch.drop(marked)
    first = scratch.written(seen.groupBy("_a", "_b").agg(*several).where("_first <> _last").select("_a", "_b", "_first", "_n"))
    repeats = join_frequent(seen, first, ["_a", "_b"], "_n").where("_first < _doc").select("_doc", "_t", F.explode("_at").alias("_at")).select("_doc", "_t", "_at", (F.col("_at") + window).alias("_to"))
    gone = scratch.written(again.union(repeats).groupBy("_doc", "_t").agg(F.collect_list(F.struct("_at", "_to")).alias("_gone")))
    scratch.drop(again, seen, first)

    kept = df.columns

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = batch.column(0), batch.column(1)
            columns, at = rows.flatten(), rows.type.get_field_index(text)
            texts, counts, removed, digests = columns[at].to_pylist(), [], [], []
            for part in K.blocks(columns[at]):
                starts, ends, first = part.words()
                words, begin = K.joined(part.buf, starts, ends)
                raw = words.tobytes()
                for i in range(len(part)):
                    a, z = int(first[i]), int(first[i + 1])
                    n, gone, text_left = z - a, 0, raw[begin[a] : begin[z] - 1] if z > a else b""
                    spans = lists[part.first + i]
                    if spans.is_valid:
                        change = np.zeros(n + 1, np.int64)
                        np.add.at(change, spans.values.field(0).to_numpy(), 1)
                        np.add.at(change, spans.values.field(1).to_numpy(), -1)
                        stays = np.concatenate([[False], np.cumsum(change[:-1]) == 0, [False]])
                        gone, edges = n - int(stays.sum()), np.flatnonzero(stays[1:] != stays[:-1])
                        text_left = b" ".join([raw[begin[a + x] : begin[a + y] - 1] for x, y in zip(edges[::2], edges[1::2], strict=True)])
                        texts[part.first + i] = text_left.decode()
                    counts.append(n)
                    removed.append(gone)
                    digests.append(hashlib.sha256(text_left).hexdigest())
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())], [*kept, "n_words", "n_removed", "kept_sha256"])

    return with_lists(df, same, gone).mapInArrow(strip, f"{fields(df)}, {ADDED}")
