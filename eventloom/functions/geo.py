"""Coordinates, distances, tiles, boxes and windows as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from eventloom.functions.clean import _col, has_value, null_if_sentinel, safe_double

EARTH_KM = 6371.0


def coordinate_flaw(c: Column | str, limit: float, profile: str = "report") -> Column:
    """P12: 'missing', 'unparsable', 'out_of_range' or null for a good coordinate."""
    x = safe_double(c)
    return F.when(~has_value(c, profile), "missing").when(x.isNull(), "unparsable").when(F.abs(x) > limit, "out_of_range")


def lon180(x: Column | str) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(_col(x) + 180, F.lit(360.0)) - 180


def lon360(x: Column | str) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(_col(x), F.lit(360.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def flat_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance, the shorter way around."""
    dlon = F.pmod(F.radians(lon2 - lon1) + math.pi, F.lit(2 * math.pi)) - math.pi
    x = dlon * F.cos((F.radians(lat1) + F.radians(lat2)) / 2)
    return EARTH_KM * F.sqrt(x * x + F.pow(F.radians(lat2 - lat1), 2))


def tile(lat: Column | str, lon: Column | str, degrees: float) -> tuple[Column, Column]:
    """Row and column of the tile; the poles' edge counts to the last row."""
    rows = math.ceil(180 / degrees)
    return F.least(F.floor((_col(lat) + 90) / degrees), F.lit(rows - 1)).cast("int"), F.floor((lon180(lon) + 180) / degrees).cast("int")


def tile_bounds(row: Column, col: Column, degrees: float, pad: float = 0.0) -> Column:
    """W, s, e, n of a tile with a margin, inside of the world."""
    return F.struct(
        F.greatest(col * degrees - 180 - pad, F.lit(-180.0)).alias("w"), F.greatest(row * degrees - 90 - pad, F.lit(-90.0)).alias("s"),
        F.least((col + 1) * degrees - 180 + pad, F.lit(180.0)).alias("e"), F.least((row + 1) * degrees - 90 + pad, F.lit(90.0)).alias("n"),
    )


def tile_tag(row: Column, col: Column) -> Column:
    """A cache key for a tile."""
    return F.format_string("r%03d_c%03d", row, col)


def utm_epsg(lat: Column | str, lon: Column | str) -> Column:
    """EPSG code of the UTM zone."""
    zone = F.least(F.floor((_col(lon) + 180) / 6) + 1, F.lit(60)).cast("int")
    return F.when(_col(lat) >= 0, zone + 32600).otherwise(zone + 32700)


def site_id(lat: Column | str, lon: Column | str, digits: int = 2) -> Column:
    """A site key from rounded coordinates."""
    form = f"%.{digits}f"
    return F.concat_ws("_", F.format_string(form, F.bround(_col(lat).cast("double"), digits) + F.lit(0.0)), F.format_string(form, F.bround(_col(lon).cast("double"), digits) + F.lit(0.0)))


def box(w: Column, s: Column, e: Column, n: Column) -> Column:
    return F.struct(w.cast("double").alias("w"), s.cast("double").alias("s"), e.cast("double").alias("e"), n.cast("double").alias("n"))


def parse_bounds(c: Column | str, lat: Column | str, lon: Column | str, half: float = 0.01) -> Column:
    """The box in a text [w,s,e,n]; else one of `half` degrees around the point."""
    a = F.from_json(null_if_sentinel(c, "manifest"), "array<double>")
    good = (F.size(a) == 4) & ~F.exists(a, lambda x: x.isNull())
    return F.when(good, box(a[0], a[1], a[2], a[3])).otherwise(box(_col(lon) - half, _col(lat) - half, _col(lon) + half, _col(lat) + half))


def box_polygon(b: Column) -> Column:
    """P20: WKT of a box, counter-clockwise from its south-west corner."""
    return F.format_string("POLYGON((%1$s %2$s,%3$s %2$s,%3$s %4$s,%1$s %4$s,%1$s %2$s))", *[b[x].cast("string") for x in "wsen"])


def boxes_meet(a: Column, b: Column) -> Column:
    """two boxes overlap or touch."""
    return (a["w"] <= b["e"]) & (b["w"] <= a["e"]) & (a["s"] <= b["n"]) & (b["s"] <= a["n"])


def in_box(lat: Column, lon: Column, b: Column, pad: float = 0.0) -> Column:
    """The point lies in the padded box, which may cross the antimeridian (w > e)."""
    x, w, e = lon180(lon), b["w"] - pad, b["e"] + pad
    across = F.when(b["w"] <= b["e"], x.between(w, e) | (x + 360).between(w, e) | (x - 360).between(w, e)).otherwise((x >= w) | (x <= e))
    return lat.between(b["s"] - pad, b["n"] + pad) & across


def in_polygon(lat: Column, lon: Column, vertices: Column) -> Column:
    """Ray casting over an array of (lon, lat) structs; the last vertex joins the first."""
    n = F.size(vertices)
    def crosses(i: Column) -> Column:
        p, q = vertices[i], vertices[F.pmod(i + 1, n)]
        straddles = (p["lat"] > lat) != (q["lat"] > lat)
        return F.when(straddles, F.when(lon < (q["lon"] - p["lon"]) * (lat - p["lat"]) / (q["lat"] - p["lat"]) + p["lon"], 1).otherwise(0)).otherwise(0)
    return F.when(n < 3, F.lit(False)).otherwise(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + crosses(i)) % 2 == 1)


def wind_speed(u: Column | str, v: Column | str) -> Column:
    """P35."""
    return F.sqrt(_col(u) * _col(u) + _col(v) * _col(v))


def wind_from(u: Column | str, v: Column | str) -> Column:
    """The direction that the wind blows from, degrees in [0, 360)."""
    return F.pmod(270 - F.degrees(F.atan2(_col(v), _col(u))), F.lit(360.0))


def clearness(cloud: Column | str) -> Column:
    """1 - cloud share; unknown counts as clear, over 1 as percent, clamped."""
    c = _col(cloud)
    share = F.when(c > 1, c / 100).otherwise(c)
    return F.when(c.isNull(), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - share)))


# Metres of ground that one pixel covers.
GROUND_M = {"S2": 10.0, "L89": 30.0, "EMIT": 60.0, "S5P": 3500.0}


def ground_m(sensor: Column | str) -> Column:
    return F.create_map(*[F.lit(x) for kv in GROUND_M.items() for x in kv])[_col(sensor)]


def patch_px(query_m: Column | float, sensor: Column | str) -> Column:
    """Pixels a side of a query window, one at least (half to even)."""
    q = F.lit(query_m) if isinstance(query_m, (int, float)) else query_m
    return F.greatest(F.lit(1), F.bround(q / ground_m(sensor), 0).cast("int"))


def anchor_sensor(sensors: Column | str, order: tuple[str, ...] = ("S2", "L89", "EMIT", "S5P")) -> Column:
    """The first sensor of the order that is there."""
    return F.coalesce(*[F.when(F.array_contains(_col(sensors), s), s) for s in order])


def top_left(dx_m: Column, dy_m: Column, sensor: Column | str, query_m: float, size: int = 512) -> Column:
    """(y, x) of a window centred dx, dy metres off the raster's centre, half to even; y grows southwards."""
    g, p = ground_m(sensor), patch_px(query_m, sensor)
    return F.struct((F.bround(size / 2 - dy_m / g, 0) - F.floor(p / 2)).cast("int").alias("y"), (F.bround(size / 2 + dx_m / g, 0) - F.floor(p / 2)).cast("int").alias("x"), p.alias("px"))


def window_inside(tl: Column, size: int = 512) -> Column:
    """The window lies in the raster."""
    return (tl["y"] >= 0) & (tl["x"] >= 0) & (tl["y"] + tl["px"] <= size) & (tl["x"] + tl["px"] <= size)


def clamp_window(at: Column, px: Column | int, size: int) -> Column:
    """The window's start moved inside the raster, and how far it moved."""
    px = F.lit(px) if isinstance(px, int) else px
    to = F.least(F.greatest(at, F.lit(0)), size - px)
    return F.struct(to.alias("at"), F.abs(to - at).alias("shift"))


def region_of(lat: Column, lon: Column, regions: dict[str, Column]) -> Column:
    """the first of the named boxes that the point lies in, null outside of all."""
    return F.coalesce(*[F.when(in_box(lat, lon, b), F.lit(name)) for name, b in regions.items()])
