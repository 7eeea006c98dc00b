"""Events to products in time and space: windows, as-of, n-th previous overpass, boxes, polygons.

Range joins are equi-joins on buckets of time as wide as the window (and cells of space) with the exact predicate
as residual; the side with windows has two rows at most.  Times are timestamps; distances are in microseconds,
never truncated.  Ties end at the least id.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from eventloom.functions import geo
from eventloom.functions.temporal import micros
from eventloom.operators import cover

DAY = 86_400_000_000


@dataclass(frozen=True)
class Names:
    """Column names of the event and product tables; `keys` stand in both and must be equal."""

    event: str = "event_id"
    time: str = "ts"
    product: str = "product_id"
    product_time: str = "acq_time"
    keys: tuple[str, ...] = ()


def _spread(us: Column, width: int) -> Column:
    return F.floor(us / F.lit(width))


def _sides(events: DataFrame, products: DataFrame, names: Names, before_days: float, after_days: float, anchor_days: float, closed: bool) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with buckets of time as wide as the window, and what holds of a pair in it."""
    target = micros(names.time) - F.lit(int(anchor_days * DAY))
    low, high = F.col("_target") - int(before_days * DAY), F.col("_target") + int(after_days * DAY)
    width = max(1, int(before_days * DAY) + int(after_days * DAY))
    left = events.withColumn("_target", target).withColumn("_low", low).withColumn("_high", high)
    left = left.withColumn("_bucket", F.explode(F.array_distinct(F.array(_spread(F.col("_low"), width), _spread(F.col("_high"), width)))))
    right = products.withColumn("_at", micros(names.product_time)).withColumn("_bucket", _spread(micros(names.product_time), width))
    inside = (F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high")) if closed else (F.col("_at") > F.col("_low")) & (F.col("_at") < F.col("_high"))
    return left, right, inside


def _told(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("dt_us", F.col("_at") - F.col("_target")).drop("_bucket", "_low", "_high", "_at", "_target")


def in_window(events: DataFrame, products: DataFrame, names: Names, before_days: float, after_days: float, anchor_days: float = 0.0, closed: bool = True) -> DataFrame:
    """Pairs whose product lies in [t - anchor - before, t - anchor + after].

    Buckets of time are as wide as the window, so an event has two rows at most, however long the window is.
    Adds `dt_us`, the product's time less the (moved) event's, signed.  closed=False leaves both ends out.
    """
    left, right, inside = _sides(events, products, names, before_days, after_days, anchor_days, closed)
    return _told(left.join(right, ["_bucket", *names.keys]).where(inside))


def in_window_and_box(events: DataFrame, products: DataFrame, names: Names, before_days: float, after_days: float, lat: str, lon: str, bounds: Column, pad: float = 0.0) -> DataFrame:
    """As `in_window`, and the event's point in the product's padded box: the pairs meet by bucket of time and
    cell of space at once, so none is formed for its time alone."""
    left, right, inside = _sides(events, products, names, before_days, after_days, 0.0, True)
    return _told(cover.points_in_boxes(left, right, lat, lon, bounds, pad, ["_bucket", *names.keys]).where(inside))


def best_pair(pairs: DataFrame, names: Names, order: Sequence[Column]) -> DataFrame:
    """Each event's first pair by the order, then by product; one aggregation, no sort."""
    rest = [c for c in pairs.columns if c not in (names.event,)]
    best = pairs.groupBy(names.event).agg(F.min_by(F.struct(*rest), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.col(names.product).alias("id"))).alias("_b"))
    return best.select(names.event, *[F.col("_b")[c].alias(c) for c in rest])


def closest(pairs: DataFrame, names: Names, cloud: str | None = None) -> DataFrame:
    """Nearest in time, then least cloud (unknown last)."""
    return best_pair(pairs, names, [F.abs("dt_us"), *([F.coalesce(F.col(cloud), F.lit(999.0))] if cloud else [])])


def closest_same_day(pairs: DataFrame, names: Names) -> DataFrame:
    """Products of the event's calendar day first, then nearest in time."""
    same = F.to_date(F.col(names.time).cast("timestamp")) == F.to_date(F.col(names.product_time).cast("timestamp"))
    return best_pair(pairs, names, [(~same).cast("int"), F.abs("dt_us")])


def least_cloud(pairs: DataFrame, names: Names, cloud: str) -> DataFrame:
    """Least cloud first, then nearest."""
    return best_pair(pairs, names, [F.coalesce(F.col(cloud), F.lit(999.0)), F.abs("dt_us")])


def in_utc_day(events: DataFrame, products: DataFrame, names: Names) -> DataFrame:
    """Pairs on the event's UTC day."""
    day = lambda c: F.to_date(F.col(c).cast("timestamp"))
    pairs = events.withColumn("_day", day(names.time)).join(products.withColumn("_day", day(names.product_time)), ["_day", *names.keys])
    return pairs.withColumn("dt_us", micros(names.product_time) - micros(names.time)).drop("_day")


def latest_before(events: DataFrame, products: DataFrame, names: Names) -> DataFrame:
    """As-of: each event's latest product strictly before it, or none (left).

    Both sides, in one table, are ordered within each key and day, and the last product seen so far is
    carried along; what earlier days left comes from one row for each key and day.  So a key of very many
    rows spreads over its days, and gaps cost nothing.  Products of equal time: the least id wins.
    """
    key = list(names.keys)
    common = [micros(names.time).alias("_t"), F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_e"), F.lit(None).cast(products.schema).alias("_p")]
    other = [micros(names.product_time).alias("_t"), F.lit(2).alias("_kind"), F.lit(None).cast(events.schema).alias("_e"), F.struct(*products.columns).alias("_p")]
    both = events.select(*key, *common).unionByName(products.select(*key, *other)).withColumn("_day", F.floor(F.col("_t") / DAY))
    # At equal times events come before products, which makes "before" strict; products descend by id.
    along = Window.partitionBy(*key, "_day").orderBy("_t", "_kind", F.col(f"_p.{names.product}").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_last", F.last("_p", ignorenulls=True).over(along)).where("_kind = 1")
    is_product = F.col("_kind") == 2
    days = both.groupBy(*key, "_day").agg(F.min_by(F.when(is_product, F.col("_p")), F.when(is_product, F.struct(-F.col("_t"), F.col(f"_p.{names.product}")))).alias("_end"))
    earlier = Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    right = days.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_day").alias("_d"), "_before")
    on = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)], F.col("_day").eqNullSafe(F.col("_d")))
    out = found.join(right, on, "left").withColumn("_last", F.coalesce("_last", "_before"))
    return out.select("_e.*", *[F.col("_last")[c].alias(c) for c in products.columns if c not in key])


class _Recent:
    """The overpasses seen last, each with the times and products of its last two: enough to find the n-th distinct one
    before an event when one overpass and one product are left out."""

    def __init__(self, n: int, back: int):
        self.n, self.back = n, back
        self.seen: dict[str | None, list[tuple[int, object]]] = {}

    def add(self, overpass: str | None, at: int, product: object) -> None:
        last = self.seen.pop(overpass, [])
        self.seen[overpass] = [(at, product), *last[:1]]
        # The oldest goes once n + 2 others are newer, those of its own time apart.
        while len(self.seen) > self.n + 2:
            oldest, rows = next(iter(self.seen.items()))
            if rows[0][0] == list(self.seen.values())[1][0][0]:
                break
            del self.seen[oldest]

    def before(self, at: int, product: object, overpass: str | None) -> tuple[int, str | None] | None:
        """(newest time, name) of the n-th distinct overpass in the window up to `at`, by time and then name."""
        left = []
        for name, rows in self.seen.items():
            newest = next((t for t, p in rows if p != product), None)
            if name != overpass and newest is not None and newest >= at - self.back:
                left.append((-newest, name is not None, name or "", name))
        if len(left) < self.n:
            return None
        left.sort(key=lambda x: x[:3])
        return -left[self.n - 1][0], left[self.n - 1][3]


def nth_previous_overpass(events: DataFrame, products: DataFrame, names: Names, overpass: str, n: int, back_days: float, t0_time: str, t0_product: str, t0_overpass: str, pick: str = "latest", cloud: str | None = None) -> DataFrame:
    """The n-th distinct overpass before the event's t0, newest first, t0's own left out.

    Events and products, in one table, are swept in order of time; what is carried along are the last few distinct
    overpasses, not the window's products.  Time is cut into buckets as wide as the window: a product stands in its
    own and the next, an event in one, so each bucket of a key is swept by itself.  Then the products of the
    overpass found are joined by its name: the latest stands for it, or the least cloudy and then latest
    (pick='cloud').  Overpasses of equal time go by name; events without an n-th overpass are left out.
    """
    back = max(1, int(back_days * DAY))
    key = list(names.keys)
    product_type = products.schema[names.product].dataType
    text = lambda c: F.col(c).cast("string")
    row = F.struct(*events.columns)
    left = events.select(*key, _spread(micros(t0_time), back).alias("_b"), micros(t0_time).alias("_t"), F.lit(1).alias("_kind"), F.col(t0_product).cast(product_type).alias("_p"), text(t0_overpass).alias("_o"), row.alias("_row"))
    at = micros(names.product_time)
    right = products.select(*key, F.explode(F.array(_spread(at, back), _spread(at, back) + 1)).alias("_b"), at.alias("_t"), F.lit(2).alias("_kind"), F.col(names.product).alias("_p"), text(overpass).alias("_o"), F.lit(None).cast(events.schema).alias("_row"))
    groups = [*key, "_b"]
    # At equal times events come first: products must be strictly before.
    swept = left.unionByName(right).where(F.col("_t").isNotNull()).repartition(*groups).sortWithinPartitions(*groups, "_t", "_kind", "_p")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, recent = None, None
        for batch in batches:
            found: list[tuple[int, int, str | None]] = []
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns - 1)]
            for i, (*group, t, kind, product, name) in enumerate(zip(*columns, strict=True)):
                if group != current:
                    current, recent = group, _Recent(n, back)
                if kind == 2:
                    recent.add(name, t, product)
                elif (nth := recent.before(t, product, name)) is not None:
                    found.append((i, *nth))
            rows, newest, named = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(batch.num_columns - 1).take(pa.array(rows, pa.int64())), pa.array(newest, pa.int64()), pa.array(named, pa.string())], ["_row", "_newest", "_name"])

    nth = swept.mapInArrow(sweep, StructType([StructField("_row", events.schema), StructField("_newest", LongType()), StructField("_name", StringType())]))
    chosen = nth.select("_row.*", "_newest", "_name")
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(key)]
    own = products.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(key)})
    near = functools.reduce(operator.and_, on, F.col("_name").eqNullSafe(text(overpass)))
    inside = (at >= micros(t0_time) - back) & (at <= F.col("_newest")) & ~F.col(names.product).eqNullSafe(F.col(t0_product))
    pairs = chosen.join(own, near).where(inside).withColumn("dt_us", at - micros(t0_time))
    rest = [c for c in [*events.columns, *[c for c in products.columns if c not in key], "dt_us"] if c not in (names.event, overpass)]
    order = [F.coalesce(F.col(cloud), F.lit(999.0)).alias("k0")] if pick == "cloud" and cloud else []
    best = pairs.groupBy(names.event, overpass).agg(F.min_by(F.struct(*rest), F.struct(*order, (-F.col("dt_us")).alias("dt"), F.col(names.product).alias("id"))).alias("_p"))
    return best.select(names.event, overpass, F.lit(n).alias("nth"), *[F.col("_p")[c].alias(c) for c in rest])


def match_with_reasons(events: DataFrame, timed: DataFrame, boxed: DataFrame, pixels: DataFrame, event: str, max_km: float, min_qa: float) -> DataFrame:
    """Every event once, with its nearest pixel or why it has none.

    `timed`, `boxed`: candidate pairs after each stage (event column); `pixels`: (event, dist_km, qa, ...),
    the nearest of each pair.
    """
    best = pixels.groupBy(event).agg(F.min_by(F.struct(*[c for c in pixels.columns if c != event]), F.struct("dist_km", *[c for c in pixels.columns if c not in (event, "dist_km", "qa")])).alias("best"))
    flag = lambda df, name: df.select(event).distinct().withColumn(name, F.lit(True))
    out = events.join(flag(timed, "_timed"), event, "left").join(flag(boxed, "_boxed"), event, "left").join(best, event, "left")
    reason = (
        F.when(F.col("_timed").isNull(), "no_time_candidate").when(F.col("_boxed").isNull(), "no_bbox_candidate").when(F.col("best").isNull(), "pixel_match_failed")
        .when(F.col("best.dist_km") > max_km, "too_far").when(F.coalesce(F.col("best.qa"), F.lit(0.0)) < min_qa, "low_qa")
    )
    return out.withColumn("reason", reason).withColumn("matched", F.col("reason").isNull()).drop("_timed", "_boxed")


def in_footprint(events: DataFrame, products: DataFrame, names: Names, lat: str, lon: str, vertices: str) -> DataFrame:
    """Pairs of one UTC day whose point lies in the product's polygon (concave, over the antimeridian too); nearest
    sensing time wins.  Pairs meet by day and cell of space at once."""
    day = lambda c: F.to_date(F.col(c).cast("timestamp"))
    pairs = cover.points_in_polygons(events.withColumn("_day", day(names.time)), products.withColumn("_day", day(names.product_time)), lat, lon, vertices, ["_day", *names.keys])
    return closest(pairs.withColumn("dt_us", micros(names.product_time) - micros(names.time)).drop("_day"), names)


def _first_inside(low: np.ndarray, high: np.ndarray, y: np.ndarray, x: np.ndarray, t: np.ndarray, w: np.ndarray, s: np.ndarray, e: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of points (y, x): the place of the first box, in the boxes' order, that holds the point and whose time is in [low, high];
    -1 without any.  t ascends.  Boxes are looked at in growing steps, only by points that have none so far."""
    found, at, end = np.full(len(y), -1), np.searchsorted(t, low, "left"), np.searchsorted(t, high, "right")
    todo, step = np.flatnonzero(at < end), 32
    while len(todo):
        for k in range(0, len(todo), max(1, (1 << 18) // step)):
            own = todo[k : k + max(1, (1 << 18) // step)]
            place = at[own][:, None] + np.arange(step)
            box = np.minimum(place, len(t) - 1)
            point, column = np.nonzero((place < end[own][:, None]) & (s[box] <= y[own][:, None]) & (y[own][:, None] <= n[box]))
            box, lon = box[point, column], x[own[point]]
            around = np.logical_or.reduce([(w[box] <= v) & (v <= e[box]) for v in (lon, lon + 360, lon - 360)])
            held = np.where(w[box] <= e[box], around, (lon >= w[box]) | (lon <= e[box]))
            first, where = np.unique(point[held], return_index=True)
            found[own[first]] = box[held][where]
        at[todo] += step
        todo, step = todo[(found[todo] < 0) & (at[todo] < end[todo])], min(step * 2, 1 << 12)
    return found


def first_covering(events: DataFrame, products: DataFrame, names: Names, lat: str, lon: str, bounds: Column, hours: float = 24.0) -> DataFrame:
    """The earliest product within the hours whose box covers the point.

    Events and products, in one table, meet by bucket of time and cell of space as in `in_window_and_box`, but no pair
    is formed: the products of a bucket and cell are swept in order of time, and each event takes the first that
    covers it.  An event has a row in two buckets at most, so the pairs aggregated in the end are few.
    """
    left, right, _ = _sides(events, products, names, hours / 24, hours / 24, 0.0, True)
    groups = ["_bucket", *names.keys, "_grid", "_row", "_col"]
    boxes = cover.box_cells(cover.computed(right, _b=bounds), F.col("_b"))
    used = boxes.select("_grid").distinct()  # five rows at most
    points = cover.with_point_cells(left, lat, lon).join(F.broadcast(used), "_grid", "left_semi")
    edges = ["w", "s", "e", "n"]
    p = boxes.select(*groups, *[F.col("_b")[k].alias(f"_{k}") for k in edges], F.struct(*products.columns).alias("_product"), F.lit(None).cast(events.schema).alias("_event"))
    e = points.select(*groups, *[F.lit(None).cast("double").alias(f"_{k}") for k in edges], F.lit(None).cast(products.schema).alias("_product"), F.struct(*events.columns).alias("_event"))
    # What follows from a row's own columns is computed after the shuffle.
    met = p.unionByName(e).where(functools.reduce(operator.and_, [F.col(g).isNotNull() for g in groups])).repartition(*groups)
    reach = int(hours / 24 * DAY)
    near = micros(F.col("_event")[names.time])
    own = {"_kind": F.col("_event").isNotNull().cast("int"), "_t": F.coalesce(micros(F.col("_product")[names.product_time]), near - reach), "_end": near + reach, "_y": F.col("_event")[lat].cast("double"), "_x": geo.lon180(F.col("_event")[lon].cast("double"))}
    # Products come first in their bucket and cell, by time and then by id.
    swept = met.withColumns(own).sortWithinPartitions(*groups, "_kind", "_t", F.col("_product")[names.product])
    k = len(groups)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            number = lambda name, b=batch: b.column(name).to_numpy(zero_copy_only=False)
            new = np.zeros(size - 1, bool)
            for c in batch.columns[:k]:
                new |= pc.not_equal(c.slice(1), c.slice(0, size - 1)).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            ends, kind = np.append(starts[1:], size), number("_kind")
            n_products = np.add.reduceat(kind == 0, starts, dtype=np.int64)
            # Cells without a product are passed over, but for the first, which may go on from before, and the last.
            for g in np.unique([0, *np.flatnonzero(n_products), len(starts) - 1]):
                start, middle, end = starts[g], starts[g] + n_products[g], ends[g]
                group = tuple(c[start].as_py() for c in batch.columns[:k])
                if group != current:
                    current, parts, held = group, [], None
                if middle > start:
                    parts.append(batch.slice(start, middle - start))
                if end == middle or not parts:
                    continue
                if held is None:
                    table = pa.Table.from_batches(parts).combine_chunks()
                    held = [table.column(c).to_numpy() for c in ("_t", *[f"_{x}" for x in edges])], table.column("_product").combine_chunks()
                at = _first_inside(*[number(c)[middle:end] for c in ("_t", "_end", "_y", "_x")], *held[0])
                some = np.flatnonzero(at >= 0)
                if len(some):
                    yield pa.RecordBatch.from_arrays([batch.column("_event").take(pa.array(middle + some)), held[1].take(pa.array(at[some]))], ["_event", "_product"])

    first = swept.mapInArrow(sweep, StructType([StructField("_event", events.schema), StructField("_product", products.schema)]))
    pairs = first.select("_event.*", *[F.col("_product")[c].alias(c) for c in products.columns if c not in names.keys])
    return best_pair(pairs.withColumn("dt_us", micros(names.product_time) - micros(names.time)), names, [micros(names.product_time)])


def two_sensor_pairs(events: DataFrame, a: DataFrame, b: DataFrame, names: Names, hours: float) -> DataFrame:
    """An observation of each of two sensors, both within the hours of the event, and the larger distance."""
    first = in_window(events, a, names, hours / 24, hours / 24).select(names.event, F.col(names.product).alias("product_a"), F.col("dt_us").alias("dt_a"))
    second = in_window(events, b, names, hours / 24, hours / 24).select(names.event, F.col(names.product).alias("product_b"), F.col("dt_us").alias("dt_b"))
    return first.join(second, names.event).withColumn("max_hours", F.greatest(F.abs("dt_a"), F.abs("dt_b")) / F.lit(3_600e6))


def every_window_filled(events: DataFrame, products: DataFrame, names: Names, offsets_days: Sequence[float], half_days: float) -> DataFrame:
    """F16: events for which each offset's window holds a product."""
    hits = functools.reduce(DataFrame.unionByName, [in_window(events, products, names, half_days, half_days, o).select(names.event, F.lit(float(o)).alias("offset")) for o in offsets_days])
    full = hits.groupBy(names.event).agg(F.count_distinct("offset").alias("n")).where(F.col("n") == len(set(offsets_days)))
    return events.join(full.select(names.event), names.event, "left_semi")


def first_rich_window(products: DataFrame, key: Sequence[str], time: str, days: int, least: int) -> DataFrame:
    """Per key the first day-aligned window of `days` days that holds `least` products."""
    day = F.to_date(F.col(time).cast("timestamp"))
    per_day = products.groupBy(*key, day.alias("day")).agg(F.count("*").alias("n"))
    starts = per_day.select(*key, "n", F.explode(F.sequence(F.date_sub("day", days - 1), F.col("day"))).alias("window_start"))
    return starts.groupBy(*key, "window_start").agg(F.sum("n").alias("n")).where(F.col("n") >= least).groupBy(*key).agg(F.min("window_start").alias("window_start"))


def around_slots(pairs: DataFrame, names: Names, most: int = 3) -> DataFrame:
    """Per event the nearest product of its day, the nearest before and the nearest after; where its
    day has none, the `most` nearest.  In order of time."""
    same = F.to_date(F.col(names.time).cast("timestamp")) == F.to_date(F.col(names.product_time).cast("timestamp"))
    kind = F.when(same, "day").when(F.col("dt_us") < 0, "before").otherwise("after")
    by_event = Window.partitionBy(names.event)
    near = [F.abs("dt_us"), F.col(names.product)]
    ranked = pairs.withColumn("slot", kind).withColumn("_any", F.max(same.cast("int")).over(by_event))
    ranked = ranked.withColumn("_k", F.row_number().over(Window.partitionBy(names.event, "slot").orderBy(*near))).withColumn("_n", F.row_number().over(by_event.orderBy(*near)))
    return ranked.where(((F.col("_any") == 1) & (F.col("_k") == 1)) | ((F.col("_any") == 0) & (F.col("_n") <= most))).drop("_any", "_k", "_n")


def wide_ranks(pairs: DataFrame, names: Names, fields: Sequence[str], k: int, prefix: str = "p") -> DataFrame:
    """Per event the k nearest products side by side."""
    ranked = pairs.withColumn("_r", F.row_number().over(Window.partitionBy(names.event).orderBy(F.abs("dt_us"), names.product))).where(F.col("_r") <= k)
    cells = [F.max(F.when(F.col("_r") == i, F.col(f))).alias(f"{prefix}{i}_{f}") for i in range(1, k + 1) for f in fields]
    return ranked.groupBy(names.event).agg(*cells)


def slots_in_window(df: DataFrame, event: str, time: str, slots: Sequence[str], before_days: float, after_days: float, hints: dict[str, Column] | None = None, most: int | None = None) -> DataFrame:
    """Wide slot times to rows inside the window; an unreadable slot takes the time in its path hint."""
    cells = [F.struct(F.lit(s).alias("slot"), F.coalesce(F.col(s).cast("timestamp"), (hints or {}).get(s, F.lit(None).cast("timestamp"))).alias("slot_time")) for s in slots]
    rows = df.withColumn("_x", F.explode(F.array(*cells))).select(*df.columns, "_x.*")
    rows = rows.withColumn("dt_us", micros("slot_time") - micros(time)).where(F.col("dt_us").between(int(-before_days * DAY), int(after_days * DAY)))
    if most is None:
        return rows
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(event).orderBy(F.abs("dt_us"), "slot"))).where(F.col("_r") <= most).drop("_r")


def without_known_times(products: DataFrame, known: DataFrame, event: str, time: str, slots: Sequence[str]) -> DataFrame:
    """Products whose time isn't in any slot column of their event."""
    seen = known.select(event, F.explode(F.array(*[F.col(s).cast("timestamp") for s in slots])).alias(time)).where(F.col(time).isNotNull())
    return products.join(seen, [event, time], "left_anti")


def usable(cloud: str | Column, most: float, null_ok: bool, *more: Column) -> Column:
    """the scene filter; whether unknown cloud passes is said, not guessed."""
    c = F.col(cloud) if isinstance(cloud, str) else cloud
    return functools.reduce(operator.and_, more, F.coalesce(c <= most, F.lit(null_ok)))
