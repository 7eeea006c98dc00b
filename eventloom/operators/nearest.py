"""Nearest points: a tree of cells without a bound on the distance, tiles for all pairs in a radius, grid look-ups."""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from eventloom.functions import geo
from eventloom.operators.cover import computed
from eventloom.operators.windows import nearest_value
from eventloom.scratch import Scratch

#: Halvings of a cell's edge from one level of the tree to the next, and the level beyond which no cell is split (1 cm).
STEP, LEVELS = 2, 15
#: Room for rounding in comparisons of chords: a millionth, and 6 mm.
_MORE, _LEAST = 1.000001, 1e-9


def _ring(df: DataFrame, lat: str, lon: str, degrees: float, km: float) -> DataFrame:
    """Rows once for each tile that a circle of `km` around them can touch (antimeridian and poles too)."""
    up = math.degrees(km / geo.EARTH_KM)
    top = F.least(F.abs(F.col(lat)) + up, F.lit(89.999))
    wide = F.when(F.abs(F.col(lat)) + up >= 89.99, 180.0).otherwise(F.least(F.lit(180.0), F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(km / geo.EARTH_KM)) / F.cos(F.radians(top)))))))
    rows, cols = math.ceil(180 / degrees), math.ceil(360 / degrees)
    r0, r1 = F.greatest(F.lit(0), F.floor((F.col(lat) - up + 90) / degrees)), F.least(F.lit(rows - 1), F.floor((F.col(lat) + up + 90) / degrees))
    c0, c1 = F.floor((geo.lon180(lon) - wide + 180) / degrees), F.floor((geo.lon180(lon) + wide + 180) / degrees)
    c1 = F.least(c1, c0 + cols - 1)
    return df.withColumn("_r", F.explode(F.sequence(r0.cast("int"), r1.cast("int")))).withColumn("_c", F.explode(F.transform(F.sequence(c0.cast("int"), c1.cast("int")), lambda c: F.pmod(c, F.lit(cols)))))


def within_radius(points: DataFrame, others: DataFrame, km: float, point: Sequence[str] = ("lat", "lon"), other: Sequence[str] = ("olat", "olon"), on: Sequence[str] = (), degrees: float = 1.0, flat: bool = False) -> DataFrame:
    """All pairs within `km` (and of equal `on`), with dist_km: an equi-join on tiles, then the distance."""
    left = _ring(points, point[0], point[1], degrees, km)
    r, c = geo.tile(other[0], other[1], degrees)
    right = others.withColumn("_r", r).withColumn("_c", F.pmod(c, F.lit(math.ceil(360 / degrees))))
    dist = (geo.flat_km if flat else geo.haversine_km)(F.col(point[0]), F.col(point[1]), F.col(other[0]), F.col(other[1]))
    return left.join(right, ["_r", "_c", *on]).withColumn("dist_km", dist).where(F.col("dist_km") <= km).drop("_r", "_c")


def _axes(lat: Column, lon: Column) -> dict[str, Column]:
    """The point on the unit sphere: chords grow with great-circle distance, and there are no poles or antimeridian."""
    return {"x": F.cos(F.radians(lat)) * F.cos(F.radians(lon)), "y": F.cos(F.radians(lat)) * F.sin(F.radians(lon)), "z": F.sin(F.radians(lat))}


def _cells(level: int) -> list[Column]:
    """The cell of a point at a level: cubes of edge 2 / 2**level around the sphere."""
    n = 1 << level
    return [F.least(F.floor((F.col(c) + 1) / 2 * n), F.lit(n - 1)).cast("int").alias(f"c{c}") for c in "xyz"]


def _chord(a: Sequence[str], b: Sequence[str]) -> Column:
    return F.sqrt(functools.reduce(operator.add, [F.pow(F.col(p) - F.col(q), 2) for p, q in zip(a, b, strict=True)]))


def _to_cell(level: int) -> Column:
    """The chord from (x, y, z) to the nearest corner, edge or face of the cell (cx, cy, cz); 0 inside of it."""
    edge = 2 / (1 << level)
    low = lambda c: F.col(f"c{c}") * edge - 1
    away = [F.greatest(F.lit(0.0), low(c) - F.col(c), F.col(c) - low(c) - edge) for c in "xyz"]
    return F.sqrt(functools.reduce(operator.add, [F.pow(a, 2) for a in away]))


def nearest(points: DataFrame, others: DataFrame, key: str, tie: str, km: float | None = None, point: Sequence[str] = ("lat", "lon"), other: Sequence[str] = ("olat", "olon"), on: Sequence[str] = (), leaf: int = 32, scratch: Scratch | None = None) -> DataFrame:
    """Each point's nearest other of equal `on`, however far (within `km` if given), with dist_km; equal
    distances end at the least `tie`.

    1. The others' distinct places form a tree of cells on the unit sphere, level by level: a cell of more than
       `leaf` places is split, so a dense area gets small cells and no task a large one.
    2. The points go down the tree together.  A cell is a candidate while it isn't farther than the nearest place
       known so far (every cell's own sample place, or `km`); at each level candidates that have been split are
       replaced by their cells, and points drop what has become too far.
    3. Only the leaves that are left are joined with their places, for the exact great-circle distance.

    So a point in the middle of nowhere meets the few cells at the rim of what is nearest, not all that lies
    within its distance.  Equal places are one place, with the row of least `tie`.  Points and others without a
    number for a coordinate, and points without an other, are left out; `key` is unique among the points.
    """
    scratch = scratch or Scratch(points.sparkSession)
    on = list(on)
    good = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rest = [c for c in others.columns if c not in on]
    lat, lon = (F.col(c).cast("double") for c in other)
    places = others.where(good(other[0]) & good(other[1])).groupBy(*on, lat.alias("_lat"), geo.lon180(lon).alias("_lon")).agg(F.min_by(F.struct(*rest), tie).alias("_o"))
    whole = scratch.written(computed(places, **_axes(F.col("_lat"), F.col("_lon"))).drop("_lat", "_lon"))
    open_places = whole.select(*on, "x", "y", "z")
    axes = _axes(F.col(point[0]).cast("double"), F.col(point[1]).cast("double"))
    bound = F.lit(2 * math.sin(min(km / (2 * geo.EARTH_KM), math.pi / 2)) if km is not None else 2.0)
    open_points = computed(points.where(good(point[0]) & good(point[1])).select(key, *on, *point), **axes).select(key, *on, "x", "y", "z", bound.alias("best"))
    cell, up = ["cx", "cy", "cz"], ["px", "py", "pz"]
    leaves: list[tuple[int, DataFrame]] = []
    for depth in range(1, LEVELS + 1):
        level = STEP * depth
        open_places = open_places.select(*on, "x", "y", "z", *_cells(level))
        sample = F.min(F.struct("x", "y", "z"))
        cells = open_places.groupBy(*on, *cell).agg(F.count("*").alias("n"), sample.alias("s"))
        cells = scratch.written(cells.select(*on, *cell, "n", *[F.col(f"s.{c}").alias(f"s{c}") for c in "xyz"]))
        parents = cells if depth == 1 else cells.select("*", *[F.shiftright(c, STEP).alias(p) for c, p in zip(cell, up, strict=True)])
        above = [*on, *up] if depth > 1 else on
        # The root has 56 cells at most (for each value of `on`).
        pairs = open_points.join(parents, above) if above else open_points.crossJoin(F.broadcast(parents))
        near, to = _to_cell(level), _chord("xyz", ["sx", "sy", "sz"])
        pairs = pairs.select(key, *on, "x", "y", "z", *cell, "n", near.alias("near"), F.least("best", to).alias("best")).where(F.col("near") <= F.col("best") * _MORE + _LEAST)
        pairs = pairs.withColumn("best", F.min("best").over(Window.partitionBy(key))).where(F.col("near") <= F.col("best") * _MORE + _LEAST)
        pairs = scratch.written(pairs)
        split = (F.col("n") > leaf) & F.lit(depth < LEVELS)
        leaves.append((level, pairs.where(~split).select(key, *on, *cell, "near", "best")))
        large = cells.where(split).select(*on, *cell)
        if large.isEmpty():
            break
        waiting = pairs.where(split).select(key, *on, "x", "y", "z", *[F.col(c).alias(p) for c, p in zip(cell, up, strict=True)], "best")
        # Leaves found at this level have their say below too: the bound came from all of a point's candidates.
        open_points = waiting
        open_places = open_places.join(large, [*on, *cell], "left_semi")
    found = functools.reduce(DataFrame.unionByName, [df.withColumn("level", F.lit(level)) for level, df in leaves])
    found = found.withColumn("best", F.min("best").over(Window.partitionBy(key))).where(F.col("near") <= F.col("best") * _MORE + _LEAST)
    found = found.select(key, *on, "level", *cell)
    if len(leaves) > 1:
        found = scratch.written(found)
    reached = functools.reduce(DataFrame.unionByName, [whole.select(*on, "_o", F.lit(level).alias("level"), *_cells(level)).join(found.where(F.col("level") == level), [*on, "level", *cell]) for level, _ in leaves])
    joined = reached.select(key, "_o.*").join(points, key)
    joined = joined.withColumn("dist_km", geo.haversine_km(F.col(point[0]), F.col(point[1]), F.col(other[0]), F.col(other[1])))
    if km is not None:
        joined = joined.where(F.col("dist_km") <= km)
    out = [c for c in [*points.columns, *rest, "dist_km"] if c != key]
    best = joined.groupBy(key).agg(F.min_by(F.struct(*out), F.struct("dist_km", tie)).alias("_b"))
    return best.select(key, *[F.col("_b")[c].alias(c) for c in out])


def nearest_within(points: DataFrame, others: DataFrame, key: str, tie: str, km: float, **how) -> DataFrame:
    """`nearest`, within `km`; points without an other there are left out."""
    return nearest(points, others, key, tie, km, **how)


def split_outliers(points: DataFrame, others: DataFrame, key: str, km: float, tie: str, **how) -> DataFrame:
    """Marks points that have no other within `km` as outliers."""
    near = nearest_within(points, others, key, tie, km, **how).select(key, F.lit(True).alias("_near"))
    return points.join(near, key, "left").withColumn("is_outlier", F.col("_near").isNull()).drop("_near")


def resample(grid: DataFrame, source: DataFrame, key: str, value: str, tie: str, km: float | None = None, **how) -> DataFrame:
    """Each grid cell takes its nearest source's value within the bound, else 0."""
    got = nearest(grid, source, key, tie, km, **how).select(key, F.col(value).alias("_v"))
    return grid.join(got, key, "left").withColumn(value, F.coalesce("_v", F.lit(0.0))).drop("_v")


def grid_lookup(points: DataFrame, grid: DataFrame, axes: dict[str, str], on: Sequence[str] = ()) -> DataFrame:
    """Each point takes the grid row of the nearest value on every axis (ties to the lower), and equal `on`.

    axes: point column -> grid axis, of any length: an hourly axis of many years too.  A point without a value for an
    axis has no grid row.
    """
    snapped = points
    for column, axis in axes.items():
        snapped = nearest_value(snapped, column, grid, axis, axis)
    return snapped.join(grid, [*axes.values(), *on], "left")


def nearest_of(columns: dict[str, Column], value: Column) -> Column:
    """The name of the column nearest to a value; ties to the first."""
    cells = F.array(*[F.struct(F.abs(c - value).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, c) in enumerate(columns.items())])
    return F.array_min(cells)["n"]
