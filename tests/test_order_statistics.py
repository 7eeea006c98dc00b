"""Ranges, percentiles, axes, distance maps, clusters and negative places against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import chips as C, nearest, splits, stats, windows


def test_ranges_split_one_repeated_value(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("i"), F.lit(7).alias("t"), F.lit(1).alias("w"))
    sizes = [r["count"] for r in windows.range_bucket(df, ["t", "i"]).groupBy("_bucket").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 400_000
    placed = windows.running_total(df.limit(20_000), "w", "t", ["i"])
    assert placed.where("before <> i").count() == 0


def test_running_total_of_nulls_ties_and_nothing(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, -1.5, 0.0, 3.0, float("inf")]), rnd.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, t double, w long")
    got = {r.i: r.before for r in windows.running_total(df, "w", "t", ["i"]).collect()}
    total, want = 0, {}
    for i, t, w in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0])):
        want[i] = total
        total += w
    assert got == want
    assert windows.running_total(df.limit(0), "w", "t", ["i"]).count() == 0


def test_axis_of_a_hundred_thousand_steps(spark):
    axis = spark.range(100_000).select((F.col("id") * 3600.0).alias("hour"), (F.col("id") % 10).alias("v"))
    rnd = random.Random(3)
    times = [rnd.uniform(-5e6, 3.7e8) for _ in range(300)] + [1800.0, 5400.0, 0.0, 3600.0 * 99_999, 1e12, -1e12] + [7200.0] * 50
    points = spark.createDataFrame([*enumerate(times), (9999, None)], "i long, t double")
    got = {r.i: r.hour for r in nearest.grid_lookup(points, axis, {"t": "hour"}).collect()}
    for i, t in enumerate(times):
        low = min(max(math.floor(t / 3600), 0), 99_999) * 3600.0
        high = min(low + 3600.0, 3600.0 * 99_999)
        assert got[i] == (low if abs(t - low) <= abs(high - t) else high), t
    assert got[9999] is None and len(got) == len(times) + 1
    assert {r.hour for r in nearest.grid_lookup(points, axis.limit(0), {"t": "hour"}).collect()} == {None}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_percentiles_by_counting_passes(spark, by):
    rnd = np.random.default_rng(4)
    values = {"a": np.concatenate([rnd.normal(size=4000), [1e300, -1e300]]), "b": np.full(3000, 2.5), "c": np.array([1.0, 2.0]), "d": np.concatenate([np.zeros(2500), rnd.exponential(size=500)])}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [("e", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = stats.percentiles(df, "v", shares, by, held=50).collect()
    for g in values if by else [None]:
        xs = values[g] if by else np.concatenate(list(values.values()))
        row = next(r for r in got if not by or r.g == g)
        for s in shares:
            assert row[f"p{round(100 * s)}"] == pytest.approx(float(np.quantile(xs, s)), rel=1e-12), (g, s)
    plain = stats.percentiles(df, "v", shares, by).collect()
    assert {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in plain if not by or r.g != "e"} == {tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in got}


def test_distances_of_large_masks():
    rnd = np.random.default_rng(5)
    for shape, share in (((2, 512, 512), 0.0005), ((3, 40, 17), 0.05), ((1, 1, 9), 0.3), ((2, 30, 1), 0.1), ((1, 64, 64), 0.9)):
        on = rnd.random(shape) < share
        on[0, -1, 0] = True
        got = C.squared_distances(on)
        for k in range(shape[0]):
            ys, xs = np.nonzero(on[k])
            for y, x in zip(rnd.integers(0, shape[1], 300), rnd.integers(0, shape[2], 300), strict=True):
                want = ((ys - y) ** 2 + (xs - x) ** 2).min() if len(ys) else np.inf
                assert got[k, y, x] == want, (shape, k, y, x)
    assert np.isinf(C.squared_distances(np.zeros((1, 5, 7), bool))).all()


def test_windows_over_distance_maps(spark):
    rnd = np.random.default_rng(6)
    masks = {i: (rnd.random((12, 10)) < 0.04).astype(float) for i in range(20)}
    masks[20] = np.zeros((12, 10))
    rows = [(i, [None if i == 3 and k == 5 else float(v) for k, v in enumerate(m.ravel())]) for i, m in masks.items()] + [(21, None), (22, [])]
    df = spark.createDataFrame(rows, "k long, m array<double>")
    w = C.window_grid(df.select("k"), 12, 10, 3, 2)
    got = {(r.k, r.y, r.x): r for r in C.distance_to_mask(w, df, ["k"], "m", 10, 3).collect()}
    masks[3].ravel()[5] = 0
    for k, m in masks.items():
        ys, xs = np.nonzero(m)
        for y in range(0, 10, 2):
            for x in range(0, 8, 2):
                if not len(ys):
                    assert (k, y, x) not in got
                    continue
                d = np.array([np.sqrt(((ys - a) ** 2 + (xs - b) ** 2).min()) for a in range(y, y + 3) for b in range(x, x + 3)])
                r = got[k, y, x]
                assert (r.min_distance, r.mean_distance, r.covered) == (pytest.approx(d.min()), pytest.approx(d.mean()), pytest.approx((d == 0).mean()))


def lloyd(rows, k, hashes):
    """Clusters by definition: farthest-first start in hash order, then centres and assignments in turns."""
    xyz = {i: (math.cos(math.radians(a)) * math.cos(math.radians(b)), math.cos(math.radians(a)) * math.sin(math.radians(b)), math.sin(math.radians(a))) for i, a, b in rows}
    order = sorted(xyz, key=lambda i: (hashes[i], i))[: 50 * k]
    d = lambda p, q: round(sum((a - b) ** 2 for a, b in zip(p, q, strict=True)), 12)
    centres = [xyz[order[0]]]
    while len(centres) < k:
        centres.append(xyz[max(order, key=lambda i: (min(d(xyz[i], c) for c in centres), -order.index(i)))])
    while True:
        of = {i: min(range(k), key=lambda c: (d(p, centres[c]), c)) for i, p in xyz.items()}
        moved = []
        for c in range(k):
            own = [xyz[i] for i in of if of[i] == c]
            mean = [sum(p[a] for p in own) / len(own) for a in range(3)] if own else centres[c]
            size = math.sqrt(sum(m * m for m in mean))
            moved.append(tuple(round(m / size, 9) for m in mean) if own else centres[c])
        if moved == centres:
            return of
        centres = moved


def test_clusters_on_the_sphere(spark):
    rnd = random.Random(7)
    seeds = [(0.0, 179.5), (0.0, -120.0), (80.0, 30.0), (-45.0, 60.0), (30.0, -30.0)]
    rows = [(i, a + rnd.gauss(0, 1.5), (b + rnd.gauss(0, 1.5) + 180) % 360 - 180) for i in range(400) for a, b in [seeds[i % 5]]]
    df = spark.createDataFrame([*rows, (1000, None, 1.0)], "i long, lat double, lon double")
    got = {r.i: r.cluster for r in splits.spherical_clusters(df, "lat", "lon", "i", 5).collect()}
    hashes = {r.i: r.h for r in df.select("i", F.xxhash64(F.col("i").cast("string"), F.lit(0)).alias("h")).collect()}
    assert got.pop(1000) is None and got == lloyd(rows, 5, hashes)
    assert len({got[i] for i in range(0, 400, 5)}) == 1  # both sides of the antimeridian
    again = {r.i: r.cluster for r in splits.spherical_clusters(df.orderBy(F.desc("i")).repartition(7), "lat", "lon", "i", 5).collect()}
    assert again.pop(1000) is None and again == got
    out = splits.cluster_split(df, "lat", "lon", "i", 5, of_rows=True)
    n = out.where("split = 'test'").count()
    assert 0 <= n - 160 < 80 and splits.leaks(out.where("cluster is not null"), "cluster").count() == 0
    assert splits.cluster_split(df.limit(0), "lat", "lon", "i").count() == 0


def test_negative_places(spark):
    rnd = random.Random(8)
    chips = []
    for i in range(80):
        px = [None if rnd.random() < (0.2, 0.6, 0.97)[i % 3] else 1.0 for _ in range(15 * 12)]
        chips.append((i, 15, 12, px, rnd.randrange(15), rnd.randrange(12)))
    chips += [(100, 4, 4, [1.0] * 16, 0, 0), (101, 6, 6, [1.0] * 36, 3, 3)]
    df = spark.createDataFrame(chips, "k long, height int, width int, px array<double>, cy int, cx int")
    got = {r.k: r.negative and (r.negative.cy, r.negative.cx) for r in C.negative_centres(df, "px", "height", "width", 2, "cy", "cx", "k", tries=30).collect()}
    part = lambda k, j, axis: int(hashlib.md5(f"{k}:{j}:{axis}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
    corner = 0
    for k, h, w, px, y, x in chips:
        corners = sorted([(-((a - y) ** 2 + (b - x) ** 2), a, b) for a in (2, h - 3) for b in (2, w - 3)])
        tries = [(a, b) for _, a, b in corners] + [(2 + math.floor(part(k, j, "y") * (h - 4)), 2 + math.floor(part(k, j, "x") * (w - 4))) for j in range(1, 31)]
        want = None
        for n, (a, b) in enumerate(tries if min(h, w) >= 5 else []):
            crop = [px[r * w + c] for r in range(a - 2, a + 3) for c in range(b - 2, b + 3)] if 2 <= a < h - 2 and 2 <= b < w - 2 else None
            if crop and not (abs(a - y) <= 5 and abs(b - x) <= 5) and sum(p is None for p in crop) <= 12.5:
                want = (a, b)
                corner += n < 4
                break
        assert got[k] == want, k
    assert corner > 20 and sum(v is not None for v in got.values()) > corner


def test_quotas_are_met_where_they_can_be(spark):
    events = spark.createDataFrame([(i, i % 10) for i in range(60)], "event long, hard int")
    calls = []

    def accept(drawn):
        calls.append(drawn.count())
        return drawn.where(F.pmod(F.col("dx") + F.col("dy"), F.lit(10)) >= F.col("hard")).drop("hard")

    got = splits.quota_draws(events, "event", {1: 16, 0: 4}, {1: 60, 0: 10}, accept, -50, 50).select("event", "label", "draw", "dx", "dy").collect()
    every = splits.draws(events, "event", 60, -50, 50, labels=(1, 0)).where("label = 1 or draw <= 10")
    want = set()
    for key, rows in itertools.groupby(sorted(every.collect(), key=lambda r: (r.event, r.label, r.draw)), key=lambda r: (r.event, r.label)):
        ok = [r for r in rows if (r.dx + r.dy) % 10 >= r.hard]
        want |= {(*key, r.draw, r.dx, r.dy) for r in ok[: 16 if key[1] else 4]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r.event == 0 and r.label == 1 for r in got) == 16 and sum(calls) < every.count()
    again = splits.quota_draws(events.repartition(7), "event", {1: 16, 0: 4}, {1: 60, 0: 10}, accept, -50, 50).select("event", "label", "draw", "dx", "dy").collect()
    assert {tuple(r) for r in again} == want
