"""Boxes and polygons as cells of a few grids: joins with points by equality, exact tests at borders only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions import geo

#: Edges of the grids' cells, in degrees.  A shape takes the finest grid of which it spans ACROSS cells or less.
EDGES, ACROSS = (0.25, 1.0, 4.0, 16.0, 60.0), 3


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """The columns, computed once a row: the optimizer doesn't copy their expressions to where they are used."""
    return df.withColumn("_once", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))).select("*", "_once.*").drop("_once")


def _span(low: str, high: str) -> Column:
    """The whole numbers from low to high; none where high is below low or either is null."""
    return F.when(F.col(high) >= F.col(low), F.sequence(F.col(low), F.col(high))).otherwise(F.array().cast("array<int>"))


def point_cells(lat: Column, lon: Column) -> Column:
    """The point's cell (_grid, _row, _col) in each grid; none without a number for a coordinate."""
    cells = F.array(*[F.struct(F.lit(k).alias("_grid"), r.alias("_row"), F.pmod(c, F.lit(math.ceil(360 / e))).alias("_col")) for k, e in enumerate(EDGES) for r, c in [geo.tile(lat, lon, e)]])
    return F.when(lat.between(-90, 90) & ~F.isnan(lon) & lon.isNotNull(), cells).otherwise(F.slice(cells, 1, 0))


def _with_cells(df: DataFrame, w: Column, s: Column, e: Column, n: Column) -> DataFrame:
    """A row for each cell that a range meets (w <= e, which may go on beyond 180): its _grid, _row and _col, and its own
    west and south border and edge (_cw, _cs, _edge)."""
    df = computed(df, _w=w, _s=s, _e=e, _n=n)
    extent, last = F.greatest(F.col("_n") - F.col("_s"), F.least(F.col("_e") - F.col("_w"), F.lit(360.0))), len(EDGES) - 1
    grid = F.coalesce(*[F.when(extent <= EDGES[k] * ACROSS, k) for k in range(last)], F.lit(last))
    df = computed(df, _grid=grid)
    df = computed(df, _edge=F.element_at(F.array(*[F.lit(x) for x in EDGES]), F.col("_grid") + 1))
    place = lambda c, base: F.floor((F.col(c) + base) / F.col("_edge"))
    end, cols = F.ceil(180 / F.col("_edge")) - 1, F.ceil(360 / F.col("_edge"))
    df = computed(df, _r0=F.least(F.greatest(place("_s", 90), F.lit(0)), end).cast("int"), _r1=F.least(place("_n", 90), end).cast("int"), _c0=place("_w", 180).cast("int"), _c1=F.least(place("_e", 180), place("_w", 180) + cols - 1).cast("int"))
    df = df.withColumn("_row", F.explode(_span("_r0", "_r1"))).withColumn("_place", F.explode(_span("_c0", "_c1")))
    df = computed(df, _col=F.pmod(F.col("_place"), cols.cast("int")), _cw=F.col("_place") * F.col("_edge") - 180, _cs=F.col("_row") * F.col("_edge") - 90)
    return df.drop("_r0", "_r1", "_c0", "_c1", "_place")


_OWN = ("_w", "_s", "_e", "_n", "_edge", "_cw", "_cs")


def box_cells(df: DataFrame, b: Column, pad: float = 0.0) -> DataFrame:
    """A row for each cell of a padded box, which may cross the antimeridian (w > e): _grid, _row, _col, and whether all
    of the cell's points lie in the box (_inner)."""
    e = F.when(b["w"] <= b["e"], b["e"]).otherwise(b["e"] + 360) + pad
    df = _with_cells(df, b["w"] - pad, b["s"] - pad, e, b["n"] + pad)
    inner = (F.col("_cw") >= F.col("_w")) & (F.col("_cw") + F.col("_edge") <= F.col("_e")) & (F.col("_cs") >= F.col("_s")) & (F.col("_cs") + F.col("_edge") <= F.col("_n"))
    return df.withColumn("_inner", inner).drop(*_OWN)


def unwrapped(vertices: Column) -> Column:
    """A polygon's vertices with longitudes that go on beyond 180 where it crosses the antimeridian (that is, where they
    would span more than half of the world otherwise)."""
    wide = F.array_max(F.transform(vertices, lambda v: v["lon"])) - F.array_min(F.transform(vertices, lambda v: v["lon"])) > 180
    return F.transform(vertices, lambda v: F.struct(F.when(wide & (v["lon"] < 0), v["lon"] + 360).otherwise(v["lon"]).alias("lon"), v["lat"].alias("lat")))


def _meets(p: Column, q: Column) -> Column:
    """The edge from p to q touches the cell: neither an axis nor the edge's own line has all of the cell on one side."""
    w, s = F.col("_cw"), F.col("_cs")
    e, n = w + F.col("_edge"), s + F.col("_edge")
    beside = (F.greatest(p["lon"], q["lon"]) < w) | (F.least(p["lon"], q["lon"]) > e) | (F.greatest(p["lat"], q["lat"]) < s) | (F.least(p["lat"], q["lat"]) > n)
    side = lambda x, y: (q["lon"] - p["lon"]) * (y - p["lat"]) - (q["lat"] - p["lat"]) * (x - p["lon"])
    corners = [side(x, y) for x in (w, e) for y in (s, n)]
    return ~beside & (F.least(*corners) <= 1e-9) & (F.greatest(*corners) >= -1e-9)


def polygon_cells(df: DataFrame, vertices: str) -> DataFrame:
    """A row for each cell of an `unwrapped` polygon, concave or not: _grid, _row, _col, _inner.  Cells that an edge touches
    are border cells; of the others those whose centre lies in the polygon are inner, the rest don't count.  A
    polygon of fewer than three vertices has none."""
    v = F.col(vertices)
    part = lambda name: F.transform(v, lambda x: x[name])
    df = _with_cells(df.where(F.size(v) >= 3), F.array_min(part("lon")), F.array_min(part("lat")), F.array_max(part("lon")), F.array_max(part("lat")))
    k = F.size(v)
    touched = F.exists(F.sequence(F.lit(0), k - 1), lambda i: _meets(F.get(v, i), F.get(v, F.pmod(i + 1, k))))
    half = F.col("_edge") / 2
    df = computed(df, _touched=touched)
    return df.where(F.col("_touched") | geo.in_polygon(F.col("_cs") + half, F.col("_cw") + half, v)).withColumn("_inner", ~F.col("_touched")).drop("_touched", *_OWN)


def with_point_cells(points: DataFrame, lat: str, lon: str) -> DataFrame:
    """A row for each of the point's cells."""
    return points.withColumn("_cell", F.explode(point_cells(F.col(lat).cast("double"), F.col(lon).cast("double")))).select(*points.columns, "_cell.*")


def _joined(points: DataFrame, shapes: DataFrame, on: Sequence[str], lat: str, lon: str, exact: Column) -> DataFrame:
    """shapes: with _grid, _row, _col, _inner."""
    return with_point_cells(points, lat, lon).join(shapes, [*on, "_grid", "_row", "_col"]).where(F.col("_inner") | exact).drop("_grid", "_row", "_col", "_inner")


def points_in_boxes(points: DataFrame, shapes: DataFrame, lat: str, lon: str, bounds: Column, pad: float = 0.0, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of a point and a box (w, s, e, n; w > e crosses the antimeridian) of equal `on` whose padded box holds the
    point.  A point has a row for each of five grids, a box one for each cell of its own; a pair meets in one
    cell at most, and only in border cells is the box looked at.  Points without coordinates are in no box."""
    shapes = computed(shapes, _b=bounds)
    return _joined(points, box_cells(shapes, F.col("_b"), pad), on, lat, lon, geo.in_box(F.col(lat), F.col(lon), F.col("_b"), pad)).drop("_b")


def points_in_polygons(points: DataFrame, shapes: DataFrame, lat: str, lon: str, vertices: str, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of a point and a polygon (an array of lon, lat; over the antimeridian too) of equal `on` that holds
    it, by ray casting where the point's cell is on the polygon's border."""
    shapes = computed(shapes, _v=unwrapped(F.col(vertices)))
    x = geo.lon180(lon)
    x = F.when(x < F.array_min(F.transform("_v", lambda v: v["lon"])), x + 360).otherwise(x)
    return _joined(points, polygon_cells(shapes, "_v"), on, lat, lon, geo.in_polygon(F.col(lat), x, F.col("_v"))).drop("_v")


def boxes_that_meet(a: DataFrame, b: DataFrame, box_a: str, box_b: str, edge: float = 1.5, on: Sequence[str] = ()) -> DataFrame:
    """pairs of boxes (w <= e) of equal `on` that overlap or touch.  Both sides stand in all cells of `edge` degrees that
    they meet; a pair is taken in the one cell that holds the south-west corner of what they share."""
    place = lambda c, side, base: F.floor((F.col(c)[side] + base) / edge).cast("int")

    def cells(df: DataFrame, c: str) -> DataFrame:
        df = computed(df, _r0=place(c, "s", 90), _r1=place(c, "n", 90), _c0=place(c, "w", 180), _c1=place(c, "e", 180))
        return df.withColumn("_row", F.explode(_span("_r0", "_r1"))).withColumn("_col", F.explode(_span("_c0", "_c1"))).drop("_r0", "_r1", "_c0", "_c1")

    x, y = F.col(box_a), F.col(box_b)
    corner = (F.col("_row") == F.floor((F.greatest(x["s"], y["s"]) + 90) / edge)) & (F.col("_col") == F.floor((F.greatest(x["w"], y["w"]) + 180) / edge))
    return cells(a, box_a).join(cells(b, box_b), [*on, "_row", "_col"]).where(geo.boxes_meet(x, y) & corner).drop("_row", "_col")
