"""Chips: rasters as rows (chip_id, band, height, width, px array<float> in row-major order).

Windows and pixel arithmetic are higher-order functions inside whole rows; only operators that combine
pixels across rows explode them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from eventloom.functions.clean import hash_fraction


def _c(x: Column | str | int) -> Column:
    return F.col(x) if isinstance(x, str) else F.lit(x) if isinstance(x, int) else x


def good(x: Column) -> Column:
    """A pixel that is a finite number."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def crop(px: Column | str, height: Column | str | int, width: Column | str | int, y: Column | str | int, x: Column | str | int, h: Column | str | int, w: Column | str | int) -> Column:
    """The h x w window at (y, x); null where it leaves the raster."""
    y, x, h, w, wide = _c(y), _c(x), _c(h), _c(w), _c(width)
    rows = F.transform(F.sequence(y, y + h - 1), lambda r: F.slice(_c(px), r * wide + x + 1, w))
    return F.when((y >= 0) & (x >= 0) & (y + h <= _c(height)) & (x + w <= wide) & (h > 0) & (w > 0), F.flatten(rows))


def crop_or_pad(px: Column | str, height: Column | str | int, width: Column | str | int, size: int) -> Column:
    """The centre size x size; outside of the raster 0."""
    h, w = _c(height), _c(width)
    top, left = F.floor((h - size) / 2), F.floor((w - size) / 2)

    def pixel(i: Column) -> Column:
        y, x = F.floor(i / size) + top, i % size + left
        return F.when((y >= 0) & (y < h) & (x >= 0) & (x < w), F.get(_c(px), (y * w + x).cast("int"))).otherwise(F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), pixel)


def place_on_grid(px: Column | str, height: Column | str | int, width: Column | str | int, size: int, dy: Column | int = 0, dx: Column | int = 0) -> Column:
    """The raster on an empty size x size grid, centred and shifted by whole pixels."""
    h, w = _c(height), _c(width)
    top, left = F.floor((F.lit(size) - h) / 2) + _c(dy), F.floor((F.lit(size) - w) / 2) + _c(dx)

    def pixel(i: Column) -> Column:
        y, x = F.floor(i / size) - top, i % size - left
        return F.when((y >= 0) & (y < h) & (x >= 0) & (x < w), F.get(_c(px), (y * w + x).cast("int"))).otherwise(F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), pixel)


def axis_positions(length: int, window: int, stride: int) -> list[int]:
    """Window starts along an axis; the last one touches the end."""
    if window > length:
        return []
    at = list(range(0, length - window + 1, stride))
    return at if at[-1] == length - window else [*at, length - window]


def window_grid(df: DataFrame, height: int, width: int, window: int, stride: int) -> DataFrame:
    """A row for each window of a regular grid."""
    places = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in axis_positions(height, window, stride) for x in axis_positions(width, window, stride)])
    return df.select(*df.columns, F.inline(places))


def resize_linear(px: Column | str, height: int, width: int, out_h: int, out_w: int) -> Column:
    """Bilinear resize with aligned corners."""
    a = _c(px)
    step = lambda n, m: (n - 1) / (m - 1) if m > 1 else 0.0
    sy, sx = step(height, out_h), step(width, out_w)

    def pixel(i: Column) -> Column:
        fy, fx = F.floor(i / out_w) * F.lit(sy), (i % out_w) * F.lit(sx)
        y0, x0 = F.least(F.floor(fy), F.lit(height - 1)), F.least(F.floor(fx), F.lit(width - 1))
        y1, x1 = F.least(y0 + 1, F.lit(height - 1)), F.least(x0 + 1, F.lit(width - 1))
        at = lambda y, x: F.get(a, (y * width + x).cast("int")).cast("double")
        wy, wx = fy - y0, fx - x0
        return at(y0, x0) * (1 - wy) * (1 - wx) + at(y0, x1) * (1 - wy) * wx + at(y1, x0) * wy * (1 - wx) + at(y1, x1) * wy * wx

    return F.transform(F.sequence(F.lit(0), F.lit(out_h * out_w - 1)), pixel)


def resize_nearest(px: Column | str, height: int, width: int, out_h: int, out_w: int) -> Column:
    """Nearest resize with aligned corners (half to even)."""
    step = lambda n, m: (n - 1) / (m - 1) if m > 1 else 0.0
    sy, sx = step(height, out_h), step(width, out_w)
    return F.transform(F.sequence(F.lit(0), F.lit(out_h * out_w - 1)), lambda i: F.get(_c(px), (F.bround(F.floor(i / out_w) * F.lit(sy), 0) * width + F.bround((i % out_w) * F.lit(sx), 0)).cast("int")))


def resize_known(px: Column | str, height: int, width: int, out_h: int, out_w: int) -> Column:
    """Bilinear resize over known pixels only: values and weights apart; null where no weight is left."""
    a = _c(px)
    value = resize_linear(F.transform(a, lambda v: F.when(good(v), v).otherwise(F.lit(0.0))), height, width, out_h, out_w)
    weight = resize_linear(F.transform(a, lambda v: good(v).cast("double")), height, width, out_h, out_w)
    return F.zip_with(value, weight, lambda v, w: F.when(w >= 1e-6, v / w))


def to_missing(px: Column | str, fills: Sequence[float] = (), limit: float = 1e20) -> Column:
    """Fill values, NaN and huge numbers to null."""
    return F.transform(_c(px), lambda v: F.when(good(v) & (F.abs(v) <= limit) & ~v.isin(*[float(f) for f in fills] or [float("nan")]), v))


def rescale(px: Column | str, scale: float = 2.75e-5, offset: float = -0.2) -> Column:
    """Integer reflectance to physical values."""
    return F.transform(_c(px), lambda v: v * scale + offset)


def share_zero(px: Column | str) -> Column:
    """The share of pixels that are zero or missing."""
    a = _c(px)
    return F.size(F.filter(a, lambda v: ~good(v) | (v == 0))) / F.size(a)


def share_missing(px: Column | str) -> Column:
    """The share of missing pixels."""
    a = _c(px)
    return F.size(F.filter(a, lambda v: ~good(v))) / F.size(a)


def mask_stats(px: Column | str) -> Column:
    """Whether the mask is binary, its positive pixels and their share."""
    a = _c(px)
    n = F.size(F.filter(a, lambda v: good(v) & (v > 0)))
    return F.struct(F.forall(a, lambda v: v.isin(0.0, 1.0)).alias("binary"), n.alias("positives"), (n / F.size(a)).alias("share"))


def mask_extent(px: Column | str, width: Column | str | int, metres: Column | float) -> Column:
    """Height, width and area of a mask's positive pixels, in pixels and metres; null without any."""
    a, w, m = _c(px), _c(width), F.lit(metres) if isinstance(metres, (int, float)) else metres
    at = F.filter(F.transform(a, lambda v, i: F.when(good(v) & (v > 0), i)), lambda i: i.isNotNull())
    ys, xs = F.transform(at, lambda i: F.floor(i / w)), F.transform(at, lambda i: i % w)
    tall, broad, n = F.array_max(ys) - F.array_min(ys) + 1, F.array_max(xs) - F.array_min(xs) + 1, F.size(at)
    return F.when(n > 0, F.struct(tall.alias("height_px"), broad.alias("width_px"), F.greatest(tall, broad).alias("max_px"), (tall * m).alias("height_m"), (broad * m).alias("width_m"), n.alias("area_px"), (n * m * m).alias("area_m2"), F.sqrt(n * m * m).alias("side_m")))


def pixel_stats(px: Column | str) -> Column:
    """Missing pixels, range, mean and deviation of the known ones, zeros."""
    known = F.filter(_c(px), good)
    n = F.size(known)
    total = F.aggregate(known, F.lit(0.0), lambda s, v: s + v)
    mean = F.try_divide(total, n)
    square = F.aggregate(known, F.lit(0.0), lambda s, v: s + v * v)
    return F.struct((F.size(_c(px)) - n).alias("n_missing"), F.array_min(known).alias("min"), F.array_max(known).alias("max"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.try_divide(square, n) - mean * mean)).alias("std"), F.try_divide(F.size(F.filter(known, lambda v: v == 0)), n).alias("zero_share"))


def mean_abs_difference(a: Column | str, b: Column | str) -> Column:
    """Over pixels known in both."""
    d = F.filter(F.zip_with(_c(a), _c(b), lambda x, y: F.when(good(x) & good(y), F.abs(x - y))), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(d, F.lit(0.0), lambda s, v: s + v), F.size(d))


def difference(a: Column | str, b: Column | str) -> Column:
    """Pixel differences."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def band_ratio_difference(now_a: Column | str, now_b: Column | str, then_a: Column | str, then_b: Column | str) -> Column:
    """(a - b) / (a + b) now less then."""
    index = lambda a, b: F.zip_with(_c(a), _c(b), lambda x, y: F.try_divide(x - y, x + y))
    return difference(index(now_a, now_b), index(then_a, then_b))


def separability(df: DataFrame, keys: Sequence[str], px: str, mask: str, least: int = 10) -> DataFrame:
    """Per chip and band, how far plume and background means lie apart, by the background's deviation and by
    the summed deviations; null with under `least` pixels in either.  Then the mean over bands."""
    pixels = df.select(*keys, F.posexplode(F.arrays_zip(F.col(px).alias("v"), F.col(mask).alias("m"))).alias("i", "p")).where(good(F.col("p.v")))
    on, off = F.when(F.col("p.m") > 0, F.col("p.v")), F.when(F.col("p.m") <= 0, F.col("p.v"))
    s = pixels.groupBy(*keys).agg(F.count(on).alias("n_on"), F.count(off).alias("n_off"), F.avg(on).alias("m_on"), F.avg(off).alias("m_off"), F.stddev_pop(on).alias("s_on"), F.stddev_pop(off).alias("s_off"))
    enough = (F.col("n_on") >= least) & (F.col("n_off") >= least)
    gap = F.abs(F.col("m_on") - F.col("m_off"))
    s = s.withColumn("d_m", F.when(enough, F.try_divide(gap, F.col("s_off")))).withColumn("d_o", F.when(enough, F.try_divide(gap, F.col("s_on") + F.col("s_off"))))
    return s.groupBy(*[k for k in keys if k != "band"]).agg(F.avg("d_m").alias("d_m"), F.avg("d_o").alias("d_o"), F.count("d_m").alias("n_bands"))


def stretch(df: DataFrame, keys: Sequence[str], px: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Each chip and band's pixels between two of its percentiles to [0, 1], clipped."""
    p = df.select(*keys, F.explode(px).alias("v")).where(good(F.col("v"))).groupBy(*keys).agg(F.percentile("v", [low, high]).alias("_p"))
    scaled = F.transform(px, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(v - F.col("_p")[0], F.col("_p")[1] - F.col("_p")[0]))))
    return df.join(p, list(keys), "left").withColumn(px, scaled).drop("_p")


def normalised(df: DataFrame, stats: DataFrame, channel: Sequence[str], px: str) -> DataFrame:
    """(x - mean) / std by channel statistics, a small table of one row a channel."""
    joined = df.join(stats.select(*channel, F.col("mean").alias("_m"), F.col("std").alias("_s")), list(channel), "left")
    return joined.withColumn(px, F.transform(px, lambda v: F.try_divide(v - F.col("_m"), F.col("_s")))).drop("_m", "_s")


def convolve_bands(spectra: DataFrame, key: Sequence[str], reflectance: str, weights: DataFrame) -> DataFrame:
    """Each target band's weighted mean of a spectrum.  weights: (band, band_idx, weight), a few hundred rows."""
    long = spectra.select(*key, F.posexplode(reflectance).alias("band_idx", "r")).where(good(F.col("r")))
    return long.join(weights, "band_idx").groupBy(*key, "band").agg(F.try_divide(F.sum(F.col("r") * F.col("weight")), F.sum("weight")).alias("value"))


def pick_bands(bands: DataFrame, low: tuple[float, float], core: tuple[float, float], high: tuple[float, float], n_low: int, n_high: int, wavelength: str = "wavelength_nm", index: str = "band_idx") -> DataFrame:
    """All bands of the core window, and evenly spaced picks of the low and high ones.

    `bands` has one row for each band of an instrument."""
    from pyspark.sql.window import Window

    def part(name: str, bounds: tuple[float, float], n: int | None) -> DataFrame:
        rows = bands.where(F.col(wavelength).between(*bounds))
        if n is None:
            return rows.select(index, wavelength, F.lit(name).alias("part"))
        order = Window.orderBy(wavelength, index)
        ranked = rows.withColumn("_r", F.row_number().over(order) - 1).crossJoin(F.broadcast(rows.agg(F.count("*").alias("_n"))))
        places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.bround(k * (F.col("_n") - 1) / F.lit(max(n - 1, 1)), 0).cast("int")))
        return ranked.where(F.array_contains(places, F.col("_r"))).select(index, wavelength, F.lit(name).alias("part"))

    return functools.reduce(DataFrame.unionByName, [part("low", low, n_low), part("core", core, None), part("high", high, n_high)]).dropDuplicates([index])


def squared_distances(on: np.ndarray) -> np.ndarray:
    """Of masks (n, height, width): each pixel's squared distance to its mask's nearest positive pixel; infinite where a
    mask has none.  Along rows by the last positive pixel on either side; then along columns by the lower envelope of
    the rows' parabolas, for all columns of all masks at once: linear in the pixels."""
    n, height, width = on.shape
    far = float(4 * (height + width) ** 2)
    place = np.arange(width)
    left = np.maximum.accumulate(np.where(on, place, -2 * (height + width)), axis=2)
    right = np.minimum.accumulate(np.where(on, place, width + 2 * (height + width))[:, :, ::-1], axis=2)[:, :, ::-1]
    along = np.minimum(np.minimum(place - left, right - place).astype(float) ** 2, far)
    f = along.transpose(1, 0, 2).reshape(height, n * width)  # a column of pixels in each column
    columns = np.arange(n * width)
    centre, border, top = np.zeros((height, n * width), np.int64), np.full((height + 1, n * width), np.inf), np.zeros(n * width, np.int64)
    border[0] = -np.inf
    for q in range(1, height):
        todo = columns
        while len(todo):
            k = top[todo]
            v = centre[k, todo]
            meet = ((f[q, todo] + q * q) - (f[v, todo] + v * v)) / (2.0 * (q - v))
            hidden = meet <= border[k, todo]
            stay, at = todo[~hidden], k[~hidden] + 1
            top[stay], centre[at, stay], border[at, stay] = at, q, meet[~hidden]
            border[np.minimum(at + 1, height), stay] = np.inf
            todo = todo[hidden]
            top[todo] -= 1
    out, k = np.empty_like(f), np.zeros(n * width, np.int64)
    for q in range(height):
        while (behind := border[np.minimum(k + 1, height), columns] < q).any():
            k += behind
        v = centre[k, columns]
        out[q] = (q - v) ** 2 + f[v, columns]
    out[out >= far] = np.inf
    return out.reshape(height, n, width).transpose(1, 0, 2)


def distance_maps(masks: DataFrame, key: Sequence[str], px: str, width: int) -> DataFrame:
    """(key, distances): each pixel's distance, in pixels, to the mask's nearest positive pixel, in the mask's order.
    Masks without one are left out; a missing pixel isn't positive; `width` divides a mask's size."""
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            pixels = batch.column(1).to_pylist()
            for i, p in enumerate(pixels):
                if p:
                    by_size.setdefault(len(p), []).append(i)
            for size, rows in by_size.items():
                step = max(1, (1 << 22) // size)
                for a in range(0, len(rows), step):
                    own = rows[a : a + step]
                    on = np.array([pixels[i] for i in own], float).reshape(len(own), size // width, width) > 0
                    d = np.sqrt(squared_distances(on)).reshape(len(own), size)
                    some = np.isfinite(d[:, 0])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(own)[some])), pa.array(list(d[some]), pa.list_(pa.float64()))], ["_key", "distances"])

    rows = masks.select(F.struct(*key).alias("_key"), F.col(px).cast("array<double>"))
    out = StructType([StructField("_key", rows.schema["_key"].dataType), StructField("distances", ArrayType(DoubleType()))])
    return rows.mapInArrow(transform, out).select("_key.*", "distances")


def distance_to_mask(windows: DataFrame, masks: DataFrame, key: Sequence[str], px: str, width: int, size: int) -> DataFrame:
    """Each window's least and mean distance (pixels) of its pixels to the mask's nearest positive pixel, and the
    share of them that are positive: from the mask's distance map, whose pixels in the window are looked at once.
    Windows lie inside of the mask; those of masks without a positive pixel are left out."""
    maps = distance_maps(masks, key, px, width).withColumn("_h", F.expr(f"cast(size(distances) / {int(width)} as int)"))
    d = crop("distances", "_h", F.lit(width), F.col("y"), F.col("x"), F.lit(size), F.lit(size))
    joined = windows.join(maps, list(key)).withColumn("_d", d)
    return joined.withColumn("min_distance", F.array_min("_d")).withColumn("mean_distance", F.aggregate("_d", F.lit(0.0), lambda s, v: s + v) / F.size("_d")).withColumn("covered", F.size(F.filter("_d", lambda v: v == 0)) / F.size("_d")).drop("distances", "_h", "_d")


def best_windows(scored: DataFrame, key: Sequence[str], score: Column, k: int) -> DataFrame:
    """The k best windows of each key, ties by place."""
    from eventloom.operators.windows import first_n_per_key

    return first_n_per_key(scored.withColumn("score", score), key, [F.desc("score"), "y", "x"], k)


def aligned_samples(draws: DataFrame, chips: DataFrame, event: str, sensors: Sequence[str], query_m: float, size: int, most_zero: float, optional: Sequence[str] = ()) -> DataFrame:
    """Draws whose window is inside and well filled in every sensor that the event has.

    draws: (event, label, draw, dx, dy) in metres; chips: (event, sensor, height, width, px).  Optional
    sensors don't decide.
    """
    from eventloom.functions import geo

    rows = draws.join(chips.where(F.col("sensor").isin(*sensors)), event)
    tl = geo.top_left(F.col("dx"), F.col("dy"), "sensor", query_m, size)
    cut = crop("px", "height", "width", F.col("_tl.y"), F.col("_tl.x"), F.col("_tl.px"), F.col("_tl.px"))
    rows = rows.withColumn("_tl", tl).withColumn("_cut", cut)
    ok = F.coalesce(share_zero("_cut") < most_zero, F.lit(False)) | F.col("sensor").isin(*optional or [""])
    return rows.groupBy(event, "label", "draw", "dx", "dy").agg(F.bool_and(ok).alias("ok"), F.array_sort(F.collect_list("sensor")).alias("sensors"))


def paired_negatives(positives: DataFrame, previous: DataFrame, event: str, most_zero: float, size: int) -> DataFrame:
    """Each positive's window one overpass earlier; where that is poor, a corner of the chip, far ones first.

    positives: (event, y, x, h); previous: (event, height, width, px)."""
    rows = positives.join(previous, event)
    far = lambda y, x: -(F.pow(F.lit(y) - F.col("y"), 2) + F.pow(F.lit(x) - F.col("x"), 2))
    corners = [(y, x) for y in (0, size) for x in (0, size)]
    options = F.array(F.struct(F.lit(float("-inf")).alias("order"), F.col("y").alias("ny"), F.col("x").alias("nx")), *[F.struct(far(y, x).alias("order"), (F.lit(1 if y else 0) * (F.col("height") - F.col("h"))).cast("int").alias("ny"), (F.lit(1 if x else 0) * (F.col("width") - F.col("h"))).cast("int").alias("nx")) for y, x in corners])
    fit = F.filter(F.array_sort(options), lambda o: F.coalesce(share_zero(crop("px", "height", "width", o["ny"], o["nx"], F.col("h"), F.col("h"))) < most_zero, F.lit(False)))
    return rows.withColumn("_o", F.get(fit, 0)).select(*positives.columns, F.col("_o.ny").alias("neg_y"), F.col("_o.nx").alias("neg_x"), F.col("_o").isNotNull().alias("found"))


def negative_centres(df: DataFrame, px: str, height: Column | str | int, width: Column | str | int, crop_half: int, cy: Column | str, cx: Column | str, key: str, half: int = 5, most_missing: float = 0.5, tries: int = 50) -> DataFrame:
    """Adds `negative` (cy, cx): the first valid centre of a crop of 2 * crop_half + 1 pixels inside the chip, or null.

    First the four corner centres, those far from (cy, cx) first, then `tries` places drawn by hash of `key` and
    number, so any engine and partitioning draws them alike.  Valid: outside of the square of `half` around (cy, cx),
    and at most `most_missing` of the crop's pixels missing."""
    h, w, y, x = _c(height), _c(width), _c(cy), _c(cx)
    size = 2 * crop_half + 1
    spots = [F.struct((-(F.pow(a - y, 2) + F.pow(b - x, 2))).alias("order"), a.cast("int").alias("cy"), b.cast("int").alias("cx")) for a in (F.lit(crop_half), h - 1 - crop_half) for b in (F.lit(crop_half), w - 1 - crop_half)]
    value = lambda k, axis, n: (F.lit(crop_half) + F.floor(hash_fraction(F.concat_ws(":", F.col(key).cast("string"), k.cast("string"), F.lit(axis))) * (n - 2 * crop_half))).cast("int")
    drawn = F.transform(F.sequence(F.lit(1), F.lit(tries)), lambda k: F.struct(k.cast("double").alias("order"), value(k, "y", h).alias("cy"), value(k, "x", w).alias("cx")))
    df = df.withColumn("_corners", F.array_sort(F.array(*spots))).withColumn("_drawn", drawn)

    def valid(s: Column) -> Column:
        outside = (F.abs(s["cy"] - y) > half) | (F.abs(s["cx"] - x) > half)
        return outside & F.coalesce(share_missing(crop(px, h, w, s["cy"] - crop_half, s["cx"] - crop_half, size, size)) <= most_missing, F.lit(False))

    fits = (h >= size) & (w >= size)
    first = F.coalesce(F.get(F.filter("_corners", valid), 0), F.get(F.filter("_drawn", valid), 0))
    found = F.when(fits, first)
    return df.withColumn("_n", found).withColumn("negative", F.when(F.col("_n").isNotNull(), F.struct(F.col("_n.cy").alias("cy"), F.col("_n.cx").alias("cx")))).drop("_corners", "_drawn", "_n")


def tile_samples(tiles: DataFrame, raster: str, date: str, key: str, px: str, done: DataFrame, most_zero: float, cap: int) -> DataFrame:
    """Well filled tiles of dates not done yet, at most `cap` a raster, those of least hash (then of least key)."""
    from eventloom.operators.windows import first_n_per_key

    fresh = tiles.where(share_zero(px) <= most_zero).join(done.select(raster, date).distinct(), [raster, date], "left_anti")
    return first_n_per_key(fresh, [raster], [hash_fraction(key), key], cap)
