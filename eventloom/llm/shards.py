"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm.kernels import mix
from eventloom.llm.tables import Scratch, fields, gapless_rank, join_frequent


class Bins:
    """Remaining capacities in a balanced search tree (a treap): tightest fit and update in O(log n)."""

    def __init__(self, capacities: Iterable[int]):
        self.left: list[int] = []
        self.right: list[int] = []
        self.room: list[int] = []
        self.priority: list[int] = []
        self.root = -1
        for c in capacities:
            self.add(c)

    def add(self, capacity: int) -> int:
        self.left.append(-1)
        self.right.append(-1)
        self.room.append(int(capacity))
        self.priority.append(int(mix(np.array([len(self.room)], np.uint64))[0]))
        self._insert(len(self.room) - 1)
        return len(self.room) - 1

    def _key(self, node: int) -> tuple[int, int]:
        return self.room[node], node

    def _split(self, node: int, key: tuple[int, int]) -> tuple[int, int]:
        if node < 0:
            return -1, -1
        if self._key(node) < key:
            a, b = self._split(self.right[node], key)
            self.right[node] = a
            return node, b
        a, b = self._split(self.left[node], key)
        self.left[node] = b
        return a, node

    def _join(self, a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        if self.priority[a] > self.priority[b]:
            self.right[a] = self._join(self.right[a], b)
            return a
        self.left[b] = self._join(a, self.left[b])
        return b

    def _insert(self, node: int) -> None:
        a, b = self._split(self.root, self._key(node))
        self.left[node] = self.right[node] = -1
        self.root = self._join(self._join(a, node), b)

    def _remove(self, node: int) -> None:
        a, rest = self._split(self.root, self._key(node))
        _, b = self._split(rest, (self.room[node], node + 1))
        self.root = self._join(a, b)

    def tightest(self, size: int) -> int | None:
        """The bin with the least room for `size`, None where none has it."""
        node, found = self.root, None
        while node >= 0:
            if self.room[node] >= size:
                found, node = node, self.left[node]
            else:
                node = self.right[node]
        return found

    def roomiest(self) -> int:
        node = self.root
        while self.right[node] >= 0:
            node = self.right[node]
        return node

    def take(self, node: int, size: int) -> None:
        self._remove(node)
        self.room[node] -= size
        self._insert(node)


def best_fit_decreasing(sizes: np.ndarray, counts: np.ndarray, bins: int, capacity: int, more: bool = False) -> tuple[np.ndarray, int]:
    """Places counts[i] groups of sizes[i], largest first, in `bins` bins of `capacity`; and how many bins there
    are then.  Rows (size, first, count, bin): of the groups of that size, `count` from the `first` on go there.

    Groups of one size go to the same bin until it has no room for another, as one by one they would.  A group
    that fits nowhere opens a bin if there may be `more`, else it goes where there is most room.
    """
    tree, out = Bins([capacity] * bins), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, left, first = int(sizes[i]), int(counts[i]), 0
        while left:
            at = tree.tightest(size)
            if at is None and more:
                at = tree.add(max(capacity, size))
            n = 1 if at is None else left if size == 0 else min(left, tree.room[at] // size)
            at = tree.roomiest() if at is None else at
            tree.take(at, n * size)
            out.append((size, first, n, at))
            first, left = first + n, left - n
    return np.array(out, np.int64).reshape(-1, 4), len(tree.room)


def fair_share(sizes: np.ndarray, counts: np.ndarray, bins: int) -> int:
    """The capacity that makes bins even: groups larger than an even share of what is left have a bin each, the
    others share the rest."""
    rest = int((sizes * counts).sum())
    for i in np.argsort(-sizes, kind="stable").tolist():
        left = int(counts[i])
        while left and bins > 1 and int(sizes[i]) * bins > rest:
            rest, bins, left = rest - int(sizes[i]), bins - 1, left - 1
        if left:
            break
    return -(-rest // bins)


def shard(df: DataFrame, size: str, group: list[str], order: list[str], n_shards: int | None = None, capacity: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Adds `shard` and `slot` (gapless from 0 in its shard, by `order`): groups stay whole, best fit decreasing.

    Give n_shards: then shards are near equal in total `size` (a group larger than an even share has a shard of
    its own, the others share the rest evenly; one that fits nowhere goes where there is most room).  Or the capacity of a shard in units
    of `size`: then a group that fits nowhere opens a shard, alone there if it is larger than the capacity.
    Rows of equal `group` columns (null equals null) are one group and go to one shard, however many they are.

    The driver has a table of the groups' different sizes with their counts (distinct numbers that add up to
    no more than the total, so fewer than the square root of twice the total) and the shards; never groups or
    rows.  From it come ranges of ranks; each group gets its rank among those of its size, and so its shard.
    A null size counts as 0; ties are broken by the group's columns; repeated rows are ordinary members of
    their group; an empty table gives no rows.  Existing columns `shard` and `slot` are replaced, others may
    have any name.
    """
    scratch = scratch or Scratch(df.sparkSession)
    df = df.drop("shard", "slot")
    named = {f"_group{k}": F.col(c) for k, c in enumerate(group)} | {f"_order{k}": F.col(c) for k, c in enumerate(order)} | {"_size": F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))}
    keys, by = [c for c in named if c.startswith("_group")], [c for c in named if c.startswith("_order")]
    rows = scratch.written(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in named.items()]))
    groups = scratch.written(rows.groupBy(*keys).agg(F.sum("_size").alias("_total"), F.count("*").alias("_n")))
    found = groups.groupBy("_total").agg(F.count("*").alias("n")).orderBy("_total").toPandas()
    sizes, counts = found["_total"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    if n_shards:
        plan, _ = best_fit_decreasing(sizes, counts, n_shards, fair_share(sizes, counts, n_shards))
    else:
        plan, _ = best_fit_decreasing(sizes, counts, 0, capacity, more=True)
    before = np.cumsum(counts) - counts  # groups in the order of their sizes
    begin = before[np.searchsorted(sizes, plan[:, 0])] + plan[:, 1]
    ranges, bins = np.sort(begin), plan[np.argsort(begin), 3].astype(np.int32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rank = (batch.column(batch.schema.names.index(x)).to_numpy() for x in ("_total", "_rank"))
            at = np.searchsorted(ranges, before[np.searchsorted(sizes, own)] + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bins[at])], [*batch.schema.names, "shard"])

    ranked = gapless_rank(groups, ["_total"], keys, "_rank")
    placed = scratch.written(ranked.mapInArrow(place, f"{fields(ranked)}, shard int").select(*keys, "_n", "shard"))
    dealt = scratch.written(join_frequent(rows, placed, keys, "_n").select("_row", *by, "shard"))
    scratch.drop(rows, groups, placed)
    return gapless_rank(dealt, ["shard"], by, "slot").select("_row.*", "shard", "slot")
