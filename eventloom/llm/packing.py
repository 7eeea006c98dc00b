"""Packing documents into sequences: cutting-stock column generation over the length histogram."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from eventloom.llm.tables import Scratch, fields, gapless_rank
from eventloom.llm.tokens import encoded

#: Lengths are rounded up to 1/CLASSES of a sequence for the linear program.
CLASSES = 256


def price(values: np.ndarray, units: int) -> tuple[float, np.ndarray]:
    """The dearest pattern: an unbounded knapsack by dynamic programming.  Class c takes c + 1 of `units`."""
    best, choice = np.zeros(units + 1), np.full(units + 1, -1)
    for u in range(1, units + 1):
        k = min(u, len(values))
        gain = best[u - k : u][::-1] + values[:k]
        c = int(gain.argmax())
        if gain[c] > best[u - 1]:
            best[u], choice[u] = gain[c], c
        else:
            best[u] = best[u - 1]
    pattern, u = np.zeros(len(values), np.int64), units
    while u > 0:
        c = choice[u]
        if c < 0:
            u -= 1
        else:
            pattern[c] += 1
            u -= c + 1
    return float(best[units]), pattern


def patterns(demand: np.ndarray, units: int, gap: float = 1e-3, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Patterns (how many pieces of each class) and how often to use each, to meet `demand` exactly.

    The linear program of least sequences is solved by column generation (revised simplex); a column
    enters while its price shows that the bound still lies over `gap` below.  Uses are rounded down;
    what is left, fewer pieces than patterns times pieces in one, is packed first fit decreasing.
    """
    some = np.flatnonzero(demand)
    if not len(some):
        return []
    m, d = len(some), demand[some].astype(float)
    columns = np.diag(units // (some + 1)).astype(float)
    inverse, x = np.diag(1 / np.diag(columns)), d / np.diag(columns)
    for _ in range(rounds):
        dual = inverse.sum(axis=0)
        values = np.zeros(len(demand))
        values[some] = dual
        worth, pattern = price(values, units)
        if worth <= 1 + gap:
            break
        column = pattern[some].astype(float)
        step = inverse @ column
        ok = step > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, np.maximum(x, 0) / np.where(ok, step, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = column
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        x = inverse @ d
    left, found = demand.astype(np.int64).copy(), []
    for j in np.argsort(-x):
        p = np.zeros(len(demand), np.int64)
        p[some] = np.rint(columns[:, j]).astype(np.int64)
        used = p > 0
        n = min(int(x[j] + 1e-6), int((left[used] // p[used]).min()))
        if n > 0:
            found.append((p, n))
            left -= n * p
    while left.any():
        p, room = np.zeros(len(demand), np.int64), units
        for c in np.flatnonzero(left)[::-1]:
            p[c] = min(left[c], room // (c + 1))
            room -= p[c] * (c + 1)
        used = p > 0
        n = int((left[used] // p[used]).min())
        found.append((p, n))
        left -= n * p
    return found


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "start"), length: str = "length", scratch: Scratch | None = None) -> DataFrame:
    """Adds `sequence_id` and `offset` (gapless from 0 in its sequence) to pieces of 1 to `capacity` tokens.

    Full pieces are sequences by themselves.  The others' lengths, in CLASSES classes, make a histogram
    of fixed size, all that the driver sees.  Its patterns are laid out as a table of rank ranges; each
    piece gets its rank within its class (by `order`, no class in one task) and from that its place.
    `order` should identify a piece; the table is read several times, so write it first.  Repeated rows are
    pieces of their own.  A piece of null length, of no token or of more than `capacity` goes nowhere:
    sequence_id and offset are null.  Existing columns of these names are replaced; an empty table gives no rows.
    """
    scratch = scratch or Scratch(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    pieces = pieces.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(length).cast("long").alias("_length"), *[F.col(c).alias(f"_order{k}") for k, c in enumerate(order)])
    order, length = [f"_order{k}" for k in range(len(order))], "_length"
    fit = F.col(length).between(1, capacity)
    unfit, pieces = pieces.where(~F.coalesce(fit, F.lit(False))), pieces.where(fit)
    unit = max(1, -(-capacity // CLASSES))
    units = capacity // unit
    size = F.ceil(F.col(length) / unit).cast("int")
    rows = pieces.withColumn("_class", F.when(size <= units, size - 1).otherwise(F.lit(None).cast("int")))
    own = F.col("_class").isNull() | (F.col(length) >= capacity)
    counted = rows.where(~own).groupBy("_class").count().collect()  # CLASSES rows at most
    demand = np.zeros(units, np.int64)
    for r in counted:
        demand[r["_class"]] = r["count"]
    used = patterns(demand, units)
    tables: dict[int, list[tuple[int, int, int, int]]] = {}
    begin, sequences = np.zeros(units, np.int64), 0
    for p, n in used:
        for c in np.flatnonzero(p):
            tables.setdefault(int(c), []).append((int(begin[c]), int(p[c]), sequences, n))
            begin[c] += n * p[c]
        sequences += n
    ranges = {c: np.array(t, np.int64).T for c, t in tables.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            kind, rank = (batch.column(names.index(x)).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("_class", "_rank"))
            sequence, nth = np.empty(len(kind), np.int64), np.empty(len(kind), np.int64)
            for c in np.unique(kind):
                at = np.flatnonzero(kind == c)
                first, each, base, _ = ranges[int(c)]
                j = np.searchsorted(first, rank[at], "right") - 1
                inside = rank[at] - first[j]
                sequence[at], nth[at] = base[j] + inside // each[j], inside % each[j]
            keep = [i for i, x in enumerate(names) if x not in ("_rank",)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(sequence), pa.array(nth)], [*(names[i] for i in keep), "sequence_id", "_nth"])

    ranked = gapless_rank(scratch.written(rows.where(~own)), ["_class"], order, "_rank")
    shared = ranked.mapInArrow(place, f"{fields(ranked.drop('_rank'))}, sequence_id long, _nth long")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "_nth").rowsBetween(Window.unboundedPreceding, -1)
    shared = shared.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long")).drop("_class", "_nth")
    alone = gapless_rank(scratch.written(rows.where(own).drop("_class")), [], order, "_rank")
    alone = alone.withColumn("sequence_id", F.col("_rank") + sequences).withColumn("offset", F.lit(0).cast("long")).drop("_rank")
    nowhere = unfit.select("*", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    placed = [x.select("_row.*", "sequence_id", "offset") for x in (shared, alone, nowhere)]
    return placed[0].unionByName(placed[1]).unionByName(placed[2])


def token_pieces(docs: DataFrame, vocabulary: str, end: int = 1, capacity: int = 2048) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): each document's ids and the end id, cut every `capacity` ids.

    Null and empty texts have the end id alone.  Rows that share a doc_id are documents of their own.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                keys, rows = part.column(0).to_pylist(), []
                for i, ids in encoded(part.column(1), vocabulary, end):
                    n = len(ids) // 4
                    rows += [(keys[i], k, min(capacity, n - k), ids[4 * k : 4 * (k + capacity)], n) for k in range(0, n, capacity)]
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")
