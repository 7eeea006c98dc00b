"""Nearest points, window joins, overpasses and covers against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from eventloom.functions import geo
from eventloom.operators import cover, match, nearest


def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def frame(spark, rows, names):
    return spark.createDataFrame(rows, names)


def world(seed):
    """Points all over, at the poles and the antimeridian; others crowded in two places, far from most points."""
    rnd = random.Random(seed)
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.randrange(3)) for i in range(120)] + [(200, 90.0, 0.0, 0), (201, -90.0, 50.0, 0), (202, 0.0, 180.0, 1), (203, 0.0, -180.0, 1), (204, 12.0, 540.0 - 360.0, 2)]
    others = [(i, 10 + rnd.gauss(0, 0.001), 20 + rnd.gauss(0, 0.001), rnd.randrange(3)) for i in range(1500)]
    others += [(2000 + i, -40 + rnd.gauss(0, 3), rnd.choice([179.9, -179.9]) + rnd.uniform(-0.1, 0.1), rnd.randrange(3)) for i in range(300)]
    others += [(3000 + i, 10.0, 20.0, i % 3) for i in range(60)] + [(4000, 89.9, 10.0, 0), (4001, 89.9, -170.0, 0)]
    return points, others


def brute(points, others, same=False, limit=None):
    out = {}
    for i, a, b, g in points:
        best = min(((km(a, b, c, d), o) for o, c, d, h in others if not same or g == h), default=None)
        if best and (limit is None or best[0] <= limit):
            out[i] = best
    return out


@pytest.mark.parametrize(("same", "limit"), [(False, None), (True, None), (False, 1500.0)])
def test_nearest_without_a_bound(spark, same, limit):
    points, others = world(1)
    p = frame(spark, [*points, (300, None, 1.0, 0), (301, float("nan"), 1.0, 0)], "pid long, lat double, lon double, g int")
    o = frame(spark, [*others, (5000, 1.0, None, 0)], "oid long, olat double, olon double, h int")
    o = o.withColumnRenamed("h", "g") if same else o
    got = {r.pid: (r.dist_km, r.oid) for r in nearest.nearest(p, o, "pid", "oid", limit, on=["g"] if same else [], leaf=8).collect()}
    want = brute(points, others, same, limit)
    assert got.keys() == want.keys()
    for i, (d, oid) in want.items():
        assert got[i][0] == pytest.approx(d, abs=1e-6) and (got[i][1] == oid or abs(d - got[i][0]) < 1e-9), i
    if limit is None:
        assert sum(d > 1000 for d, _ in want.values()) > 50


def test_nearest_ties_repeats_and_nothing(spark):
    p = frame(spark, [(1, 0.0, 0.0), (2, 50.0, 50.0)], "pid long, lat double, lon double")
    o = frame(spark, [(9, 0.0, 1.0), (8, 0.0, 1.0), (7, 0.0, 361.0), (6, 1.0, 0.0)], "oid long, olat double, olon double")
    got = {r.pid: r.oid for r in nearest.nearest(p, o, "pid", "oid").collect()}
    assert got[1] == 6 or got[1] == 7  # a degree on either axis: rounding decides
    assert nearest.nearest(p, o.where("oid > 6"), "pid", "oid").where("pid = 1").first().oid == 7
    assert nearest.nearest(p, o.limit(0), "pid", "oid").count() == 0 and nearest.nearest(p.limit(0), o, "pid", "oid").count() == 0


def test_a_dense_tile_is_split(spark):
    """40,000 places in one square degree: a point far off meets a few hundred of them, not all."""
    o = spark.range(40_000).select(F.col("id").alias("oid"), (F.lit(30.0) + (F.col("id") % 200) / 200).alias("olat"), (F.lit(40.0) + F.floor(F.col("id") / 200) / 200).alias("olon"))
    p = frame(spark, [(1, -20.0, -100.0), (2, 30.5012, 40.5012), (3, 31.5, 41.5)], "pid long, lat double, lon double")
    got = {r.pid: (r.oid, r.dist_km) for r in nearest.nearest(p, o, "pid", "oid").collect()}
    rows = [(r.oid, r.olat, r.olon) for r in o.collect()]
    for i, a, b in [(1, -20.0, -100.0), (2, 30.5012, 40.5012), (3, 31.5, 41.5)]:
        d, oid = min((km(a, b, c, e), x) for x, c, e in rows)
        assert got[i] == (oid, pytest.approx(d, abs=1e-6))


def times(spark, rows, names, column):
    return spark.createDataFrame(rows, names).withColumn(column, F.timestamp_micros(column))


HOUR = 3_600_000_000


@pytest.fixture(scope="module")
def passes(spark):
    rnd = random.Random(4)
    products = [(i, rnd.choice("ab"), rnd.randrange(0, 3000) * HOUR // 7, rnd.choice([None, *"pqrstuvwxyz"]), rnd.choice([None, 5.0, 50.0])) for i in range(600)]
    events = [(i, rnd.choice("abc"), rnd.randrange(0, 3000) * HOUR // 7, rnd.randrange(600)) for i in range(150)]
    by = {p[0]: p for p in products}
    events = [(i, k, by[q][2] if rnd.random() < 0.6 else t, q, by[q][3] if rnd.random() < 0.9 else "zz") for i, k, t, q in events]
    e = times(spark, events, "event_id long, k string, t0_time long, t0_product long, t0_overpass string", "t0_time")
    p = times(spark, products, "product_id long, k string, acq_time long, overpass string, cloud double", "acq_time")
    return events, products, e, p


@pytest.mark.parametrize(("n", "back", "pick"), [(1, 3.0, "latest"), (2, 120.0, "latest"), (3, 1.5, "cloud"), (2, 20.0, "cloud"), (5, 9.0, "latest")])
def test_nth_previous_overpass(passes, n, back, pick):
    events, products, e, p = passes
    want = {}
    for i, k, t, q, o in events:
        seen: dict = {}
        for pid, pk, at, name, cloud in products:
            if pk == k and t - int(back * 24 * HOUR) <= at < t and pid != q and name != o:
                seen.setdefault(name, []).append((at, pid, cloud))
        order = sorted(seen, key=lambda x: (-max(seen[x])[0], x is not None, x or ""))
        if len(order) >= n:
            rank = (lambda x: (999.0 if x[2] is None else x[2], -x[0], x[1])) if pick == "cloud" else (lambda x: (-x[0], x[1]))
            want[i] = (order[n - 1], min(seen[order[n - 1]], key=rank)[1])
    names = match.Names("event_id", "t0_time", "product_id", "acq_time", ("k",))
    out = match.nth_previous_overpass(e, p, names, "overpass", n, back, "t0_time", "t0_product", "t0_overpass", pick, "cloud")
    assert {r.event_id: (r.overpass, r.product_id) for r in out.collect()} == want and len(want) > 20


def test_windows_have_two_rows_an_event(passes):
    events, products, e, p = passes
    names = match.Names("event_id", "t0_time", "product_id", "acq_time", ("k",))
    for before, after, anchor in ((120, 0, 0), (1.5, 0.5, 5), (0, 0, 0), (0.01, 3, -2)):
        got = {(r.event_id, r.product_id) for r in match.in_window(e, p, names, before, after, anchor).collect()}
        want = {(i, x) for i, k, t, *_ in events for x, pk, at, *_ in products if pk == k and t - anchor * 24 * HOUR - int(before * 24 * HOUR) <= at <= t - anchor * 24 * HOUR + int(after * 24 * HOUR)}
        assert got == want, (before, after)


def inside(lat, lon, shape):
    if max(x for x, _ in shape) - min(x for x, _ in shape) > 180:
        shape = [(x + 360 if x < 0 else x, y) for x, y in shape]
        lon = lon + 360 if lon < min(x for x, _ in shape) else lon
    odd = False
    for (x1, y1), (x2, y2) in zip(shape, shape[1:] + shape[:1], strict=True):
        if (y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_points_in_concave_polygons(spark):
    rnd = random.Random(8)
    shapes = []
    for i in range(60):
        x, y, r = rnd.uniform(-180, 180), rnd.uniform(-70, 70), rnd.choice([0.1, 1.0, 8.0, 15.0])
        star = [(x + (r if k % 2 else r / 3) * math.cos(k * math.pi / 5), y + (r if k % 2 else r / 3) * math.sin(k * math.pi / 5)) for k in range(10)]
        shapes.append((i, i % 2, [((a + 180) % 360 - 180, b) for a, b in star]))
    shapes += [(60, 0, [(-170.0, -10.0), (170.0, -10.0), (170.0, 10.0), (-170.0, 10.0)]), (61, 0, [(0.0, 0.0), (1.0, 1.0)]), (62, 0, [(-100.0, -80.0), (60.0, -80.0), (60.0, 80.0), (20.0, -70.0), (-60.0, -70.0), (-100.0, 80.0)])]
    points = [(i, rnd.uniform(-89, 89), rnd.uniform(-180, 180), rnd.randrange(2)) for i in range(400)]
    points += [(1000 + k, y + rnd.gauss(0, 1), (x + rnd.gauss(0, 1) + 180) % 360 - 180, i % 2) for k, (i, _, s) in enumerate(shapes[:60] * 4) for x, y in [s[0]]] + [(5000, None, 1.0, 0), (5001, 1.0, None, 1)]
    p = frame(spark, points, "pid long, lat double, lon double, g int")
    s = frame(spark, [(i, g, [{"lon": x, "lat": y} for x, y in v]) for i, g, v in shapes], "sid long, g int, shape array<struct<lon:double,lat:double>>")
    rows = cover.points_in_polygons(p, s, "lat", "lon", "shape", ["g"]).select("pid", "sid").collect()
    got = {(r.pid, r.sid) for r in rows}
    want = {(i, j) for i, a, b, g in points for j, h, v in shapes if a is not None and b is not None and g == h and len(v) > 2 and inside(a, b, v)}
    assert got == want and len(rows) == len(got) and len(want) > 100


def test_points_in_boxes(spark):
    rnd = random.Random(9)
    boxes = []
    for i in range(120):
        w, s, width, height = rnd.uniform(-180, 180), rnd.uniform(-90, 80), rnd.choice([0.05, 2.0, 40.0, 200.0, 359.0]), rnd.choice([0.05, 3.0, 60.0])
        e = w + width
        boxes.append((i, w, s, e - 360 if e > 180 else e, min(90.0, s + height)))
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)] + [(900 + k, b[2], b[1]) for k, b in enumerate(boxes)] + [(2000, 90.0, 0.0), (2001, -90.0, -180.0), (2002, None, 0.0)]
    p = frame(spark, points, "pid long, lat double, lon double")
    b = frame(spark, boxes, "bid long, w double, s double, e double, n double")
    bounds = geo.box(F.col("w"), F.col("s"), F.col("e"), F.col("n"))
    for pad in (0.0, 2.0):
        rows = cover.points_in_boxes(p, b, "lat", "lon", bounds, pad).select("pid", "bid").collect()
        want = {(r.pid, r.bid) for r in p.crossJoin(b).where(geo.in_box(F.col("lat"), F.col("lon"), bounds, pad)).collect()}
        assert {(r.pid, r.bid) for r in rows} == want and len(rows) == len(want) > 300


@pytest.mark.parametrize("batch", [3, 10_000])
def test_first_covering_forms_few_pairs(spark, monkeypatch, batch):
    """Against all pairs; what is aggregated in the end are two rows an event at most, not every pair."""
    from eventloom.scratch import setting

    rnd = random.Random(11)
    products = [(i, rnd.choice("ab"), rnd.randrange(60) * HOUR // 2, rnd.uniform(-180, 180), rnd.uniform(-90, 60), rnd.choice([3.0, 40.0, 350.0]), rnd.choice([2.0, 30.0])) for i in range(400)]
    products = [(i, g, t, w, s, w + a - 360 if w + a > 180 else w + a, s + b) for i, g, t, w, s, a, b in products] + [(900, "a", None, 0.0, 0.0, 9.0, 9.0), (901, None, HOUR, -180.0, -90.0, 180.0, 90.0)]
    products += [(1000 + i, "c", 100 * HOUR + i % 9, -10.0, -10.0, 10.0, 10.0) for i in range(300)]  # one cell's crowd, with ties
    events = [(i, rnd.choice("abz"), rnd.randrange(60) * HOUR // 2, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)]
    events += [(500 + k, "a", t, y, x) for k, (t, y, x) in enumerate([(None, 1.0, 1.0), (HOUR, None, 1.0), (HOUR, 1.0, None), (HOUR, 90.0, 180.0)])] + [(501 + i, "c", 100 * HOUR, i % 12 * 1.0, 5.0) for i in range(300)]
    e = times(spark, events, "event_id long, g string, ts long, lat double, lon double", "ts")
    p = times(spark, products, "product_id long, g string, acq_time long, w double, s double, e double, n double", "acq_time")
    names, bounds = match.Names(keys=("g",)), geo.box(F.col("w"), F.col("s"), F.col("e"), F.col("n"))
    near = F.abs(F.unix_micros("acq_time") - F.unix_micros("ts")) <= 5 * HOUR
    pairs = e.join(p, "g").where(near & geo.in_box(F.col("lat"), F.col("lon"), bounds))
    want = {r.event_id: r.b.product_id for r in pairs.groupBy("event_id").agg(F.min(F.struct("acq_time", "product_id")).alias("b")).collect()}
    last, seen = match.best_pair, []
    monkeypatch.setattr(match, "best_pair", lambda rows, *more: seen.append(rows) or last(rows, *more))
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", batch):
        got = match.first_covering(e, p, names, "lat", "lon", bounds, 5.0)
        assert {"event_id", "g", "ts", "lat", "lon", "product_id", "acq_time", "w", "s", "e", "n", "dt_us"} == set(got.columns)
        rows = got.collect()
        assert {r.event_id: r.product_id for r in rows} == want and len(rows) == len(want) > 300
        assert all(r.dt_us == (r.acq_time - r.ts) / dt.timedelta(microseconds=1) for r in rows)
        assert seen[0].count() <= 2 * len(events) < pairs.count()


def test_boxes_that_meet(spark):
    rnd = random.Random(10)
    make = lambda n: [(i, (w := rnd.uniform(-170, 150)), (s := rnd.uniform(-80, 70)), w + rnd.choice([0.0, 1.0, 15.0]), s + rnd.choice([0.0, 2.0, 9.0])) for i in range(n)]
    a, b = make(150), make(150)
    side = lambda rows, c: frame(spark, rows, f"{c} long, w double, s double, e double, n double").select(c, geo.box(*[F.col(x) for x in "wsen"]).alias(f"box_{c}"))
    rows = cover.boxes_that_meet(side(a, "a"), side(b, "b"), "box_a", "box_b").select("a", "b").collect()
    want = {(i, j) for i, w, s, e, n in a for j, x, t, f, m in b if w <= f and x <= e and s <= m and t <= n}
    assert {(r.a, r.b) for r in rows} == want and len(rows) == len(want) > 20


def test_no_pair_is_formed_outside_the_cover(spark):
    """A footprint of one cell and points in every other cell: the join itself forms no pair."""
    p = spark.range(1000).select(F.col("id").alias("pid"), (F.col("id") % 170 - 85).cast("double").alias("lat"), ((F.col("id") * 7) % 340 - 170).cast("double").alias("lon"))
    s = frame(spark, [(1, [{"lon": 0.55, "lat": 0.55}, {"lon": 0.6, "lat": 0.55}, {"lon": 0.6, "lat": 0.6}])], "sid long, shape array<struct<lon:double,lat:double>>")
    cells = cover.polygon_cells(s, "shape").collect()
    assert len(cells) == 1 and not cells[0]["_inner"] and cells[0]["_grid"] == 0
    assert cover.points_in_polygons(p, s, "lat", "lon", "shape").count() == 0
