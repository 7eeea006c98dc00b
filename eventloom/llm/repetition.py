"""Quality rules on repetition: suffix arrays over words, LCP intervals, maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.llm import kernels as K

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, repeat_fraction double, longest_repeat long, base_failed boolean, kept boolean"


@dataclass(frozen=True)
class Rules:
    """min_words, window and max_window_share are the base rules; the others bound maximal repeats:
    those of `min_repeat` words or more may cover `max_fraction` of the words, and none may be
    longer than `max_longest` of them."""

    min_words: int = 10
    window: int = 5
    max_window_share: float = 0.20
    min_repeat: int = 8
    max_fraction: float = 0.18
    max_longest: float = 0.08
    longest_floor: int = 50


def ranks_by_doubling(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffix array over all rows' words, as ranks, by prefix doubling.

    `rows` is each word's row: suffixes of different rows never count as equal.  Returns each word's
    end of row and for each doubling h = 1, 2, 4 ... (h, rank): equal ranks mean that the h words from
    there on are equal; the last ranks are all different and order the suffixes.  A suffix alone with
    its prefix drops out of the sorting, so rounds after the first touch only what repeats.
    """
    n = len(words)
    order = np.lexsort((words, rows))
    new = np.ones(n, bool)
    new[1:] = (words[order[1:]] != words[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels = [(1, rank)]
    h = 1
    end = np.searchsorted(rows, rows, "right") if n else rows
    while n and len(live := np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)):
        far = live + h
        second = np.where(far < end[live], rank[np.minimum(far, n - 1)] + 1, -live)  # past the end: equal to none
        by = np.lexsort((second, rank[live]))
        at, group, second = live[by], rank[live[by]], second[by]
        head = np.ones(len(at), bool)
        head[1:] = group[1:] != group[:-1]
        new = head.copy()
        new[1:] |= second[1:] != second[:-1]
        place = group + np.arange(len(at)) - np.flatnonzero(head)[np.cumsum(head) - 1]
        rank = rank.copy()
        rank[at] = place[np.flatnonzero(new)[np.cumsum(new) - 1]]
        h *= 2
        levels.append((h, rank))
    return end, levels


def equal_from(levels: list[tuple[int, np.ndarray]], end: np.ndarray, n_words: int) -> np.ndarray:
    """A class for each position: equal classes mean that the `n_words` words from there on are equal; -1 where the row ends before."""
    h, rank = [x for x in levels if x[0] <= n_words][-1]
    n = len(rank)
    at = np.arange(n)
    fits = at + n_words <= end
    far = np.minimum(at + n_words - h, max(n - 1, 0))
    out = np.where(fits, rank * (n + 1) + rank[far], -1) if n else rank
    return out


def repeated(classes: np.ndarray) -> np.ndarray:
    """Positions whose class (not -1) occurs twice or more."""
    at = np.flatnonzero(classes >= 0)
    if not len(at):
        return at
    c = classes[at]
    order = np.argsort(c, kind="stable")
    s = c[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    same[:-1] |= same[1:]
    return np.sort(at[order[same]])


def longest_common(levels: list[tuple[int, np.ndarray]], end: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each of `starts`, the longest prefix (words) that its row has elsewhere too: the greater of the
    LCPs with both neighbours in the suffix array, that is the depth of its deepest LCP interval."""
    if not len(starts):
        return starts
    best = np.zeros(len(starts), np.int64)
    order = np.argsort(levels[-1][1][starts])
    a, b = starts[order[:-1]], starts[order[1:]]
    x, y, last = a.copy(), b.copy(), len(end) - 1
    for h, rank in reversed(levels):
        ok = (x + h <= end[a]) & (y + h <= end[b]) & (rank[x.clip(max=last)] == rank[y.clip(max=last)])
        x[ok] += h
        y[ok] += h
    common = x - a
    best[order[:-1]] = common
    best[order[1:]] = np.maximum(best[order[1:]], common)
    return best


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n words lie in the union of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def measure(texts: K.Texts, rules: Rules) -> dict[str, np.ndarray]:
    buf, rows = texts.buf, len(texts)
    starts, ends, first = texts.words()
    n_words = np.diff(first)
    per_row = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.offsets])
    in_word = ~K.SEPARATOR[buf]
    out = {"n_words": n_words, "word_chars": per_row(in_word & ((buf & 0xC0) != 0x80)), "n_symbols": per_row(SYMBOLS[buf])}

    a, b, line_first = texts.lines()
    line_row = np.repeat(np.arange(rows), np.diff(line_first))
    worded = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, line_row = a[worded], b[worded], line_row[worded]
    _, line = K.classes(buf, a, b)
    order = np.lexsort((line, line_row))
    again = (line[order[1:]] == line[order[:-1]]) & (line_row[order[1:]] == line_row[order[:-1]]) if len(a) else np.zeros(0, bool)
    out["n_dup_lines"] = np.bincount(line_row[order[1:]][again] if len(a) else line_row, minlength=rows)[:rows] if len(a) else np.zeros(rows, np.int64)

    n = len(starts)
    row = np.repeat(np.arange(rows), n_words)
    end, levels = ranks_by_doubling(K.classes(buf, starts, ends)[1], row)
    in_row = lambda flags: np.bincount(row[flags], minlength=rows)
    out["n_repeat_words"] = in_row(covered(repeated(equal_from(levels, end, rules.window)), rules.window, n))
    deep = repeated(equal_from(levels, end, rules.min_repeat))
    lengths = longest_common(levels, end, deep)
    cover = in_row(covered(deep, lengths, n))
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, row[deep], lengths)
    out["repeat_fraction"], out["longest_repeat"] = cover / np.maximum(n_words, 1), longest
    out["base_failed"] = (n_words < rules.min_words) | (out["n_repeat_words"] > rules.max_window_share * n_words)
    out["kept"] = ~out["base_failed"] & (out["repeat_fraction"] <= rules.max_fraction) & (longest <= np.maximum(rules.longest_floor, rules.max_longest * n_words))
    return out


def repetition(df: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """Adds the counts of `COLUMNS` and the verdict `kept` to each row.

    Within each text a suffix array over its words (as numbers of their contents) is built by prefix doubling; its LCP
    intervals of `min_repeat` words or more are the maximal repeated substrings, their union of spans
    gives `repeat_fraction`, the deepest interval `longest_repeat`.  Overlapping repeats count once.
    Null and empty texts have no words: they fail the base rules.  Rows are judged alone, so repeated rows
    get the same values and an empty table gives none.  Existing columns of these names are replaced.  No shuffle; a task holds about a megabyte of text at a time, or one text.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    df = df.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t, rules) for t in K.blocks(batch.column(batch.schema.names.index(text)))]
            columns = [np.concatenate([x[c] for x in found]) if found else np.zeros(0) for c in names]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in columns)], [*batch.schema.names, *names])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)
    return df.mapInArrow(run, f"{fields}, {COLUMNS}")
