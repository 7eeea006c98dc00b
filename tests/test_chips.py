"""Chip operators against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from eventloom.operators import chips as C


def frame(spark, *arrays):
    return spark.createDataFrame([(i, a.shape[0], a.shape[1], [float(x) for x in a.ravel()]) for i, a in enumerate(arrays)], "chip_id int, height int, width int, px array<double>")


def linear(a: np.ndarray, h: int, w: int) -> np.ndarray:
    ys, xs = np.linspace(0, a.shape[0] - 1, h), np.linspace(0, a.shape[1] - 1, w)
    rows = np.stack([np.interp(xs, np.arange(a.shape[1]), r) for r in a])
    return np.stack([np.interp(ys, np.arange(a.shape[0]), c) for c in rows.T], axis=1)


@pytest.mark.parametrize(("h", "w"), [(3, 3), (9, 12), (1, 5), (6, 7)])
def test_resize_linear(spark, h, w):
    a = np.random.default_rng(0).normal(size=(6, 7))
    got = frame(spark, a).select(C.resize_linear("px", 6, 7, h, w).alias("r")).first().r
    want = linear(a, h, w) if h > 1 else np.interp(np.linspace(0, 6, w), np.arange(7), a[0])[None]
    assert np.allclose(np.reshape(got, (h, w)), want)


def test_resize_nearest(spark):
    a = np.arange(36.0).reshape(6, 6)
    got = frame(spark, a).select(C.resize_nearest("px", 6, 6, 3, 3).alias("r")).first().r
    at = [int(np.round(k * 2.5)) for k in range(3)]
    assert got == [a[y, x] for y in at for x in at]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 2**25 - 1))
def test_mask_extent(spark, bits):
    a = np.array([(bits >> k) & 1 for k in range(25)], float).reshape(5, 5)
    got = frame(spark, a).select(C.mask_extent("px", 5, 10.0).alias("e"), C.mask_stats("px").alias("s")).first()
    ys, xs = np.nonzero(a)
    if len(ys) == 0:
        assert got.e is None
    else:
        assert (got.e.height_px, got.e.width_px, got.e.area_px) == (np.ptp(ys) + 1, np.ptp(xs) + 1, len(ys))
    assert got.s.binary and got.s.positives == len(ys)


def test_window_positions():
    assert C.axis_positions(10, 4, 3) == [0, 3, 6] and C.axis_positions(10, 4, 4) == [0, 4, 6] and C.axis_positions(3, 4, 1) == [] and C.axis_positions(4, 4, 9) == [0]


def test_distances_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    masks = [(rng.random((8, 8)) < 0.2).astype(float), np.pad(np.ones((4, 4)), 2)]
    df = frame(spark, *masks)
    windows = C.window_grid(df.select("chip_id"), 8, 8, 3, 2)
    got = C.distance_to_mask(windows, df.select("chip_id", "px"), ["chip_id"], "px", 8, 3).collect()
    for r in got:
        ys, xs = np.nonzero(masks[r.chip_id])
        d = [np.hypot(ys - y, xs - x).min() for y in range(r.y, r.y + 3) for x in range(r.x, r.x + 3)]
        assert r.min_distance == pytest.approx(min(d)) and r.mean_distance == pytest.approx(np.mean(d))


def test_spectra(spark):
    rng = np.random.default_rng(5)
    spectra, w = rng.random((4, 20)), rng.random((3, 20))
    df = spark.createDataFrame([(i, [float(x) for x in s]) for i, s in enumerate(spectra)], "i int, r array<double>")
    weights = spark.createDataFrame([(b, k, float(w[b, k])) for b in range(3) for k in range(20)], "band int, band_idx int, weight double")
    got = {(r.i, r.band): r.value for r in C.convolve_bands(df, ["i"], "r", weights).collect()}
    want = spectra @ (w / w.sum(axis=1, keepdims=True)).T
    assert all(got[i, b] == pytest.approx(want[i, b]) for i in range(4) for b in range(3))
    bands = spark.createDataFrame([(k, 2000.0 + 10 * k) for k in range(50)], "band_idx int, wavelength_nm double")
    picked = C.pick_bands(bands, (2000, 2090), (2100, 2190), (2200, 2490), 3, 4).groupBy("part").agg(F.sort_array(F.collect_list("band_idx")).alias("b")).collect()
    assert {r.part: r.b for r in picked} == {"low": [0, 4, 9], "core": list(range(10, 20)), "high": [20, 30, 39, 49]}


def test_placement(spark):
    a = np.arange(1.0, 5.0).reshape(2, 2)
    got = frame(spark, a).select(C.place_on_grid("px", "height", "width", 4, 1, 0).alias("g")).first().g
    want = np.zeros((4, 4))
    want[2:4, 1:3] = a
    assert np.array_equal(np.reshape(got, (4, 4)), want)


def test_paired_negatives_fall_back_to_far_corners(spark):
    poor = np.ones((8, 8))
    poor[:4, :4] = 0
    positives = spark.createDataFrame([("e", 0, 0, 3), ("f", 5, 5, 3)], "event string, y int, x int, h int")
    previous = spark.createDataFrame([(k, 8, 8, poor.ravel().tolist()) for k in "ef"], "event string, height int, width int, px array<double>")
    got = {r.event: (r.neg_y, r.neg_x) for r in C.paired_negatives(positives, previous, "event", 0.5, 8).collect()}
    assert got == {"e": (5, 5), "f": (5, 5)}


def test_separability_needs_enough_pixels(spark):
    px, few = [float(k) for k in range(40)], [1.0] * 9 + [0.0] * 31
    df = spark.createDataFrame([(1, 0, px, [1.0] * 10 + [0.0] * 30), (2, 0, px, few)], "chip_id int, band int, px array<double>, mask array<double>")
    got = {r.chip_id: r for r in C.separability(df, ["chip_id", "band"], "px", "mask").collect()}
    assert got[1].d_m == pytest.approx((24.5 - 4.5) / np.std(np.arange(10, 40))) and got[2].d_m is None and got[2].n_bands == 0


def test_ratio_changes_round_once(spark, tmp_path):
    """A sum a little below a half, one that is above it, chips without a pixel that counts, and an id that comes twice."""
    import duckdb

    from eventloom.plans.queries import QUERIES, SQL

    def chip(r=None, n=1):
        return [0.0] * 64 if r is None else [(1 - r) / (1 + r)] * n + [0.0] * (64 - n)

    ones = [1.0] * 64
    rows = [(0, ones), (1, chip(0.124998)), (10, ones), (11, chip(0.125002)), (20, chip()), (21, chip()), (30, ones), (30, ones), (31, chip(0.2, 3))]
    spark.createDataFrame([(k, [float(x) for x in v], 0) for k, v in rows], "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(SQL["ratio_changes"]).fetchall())
    assert sorted((r.chip_id, r.total) for r in QUERIES["ratio_changes"](spark, str(tmp_path)).select("chip_id", "total").collect()) == want
    assert [k for k, _ in want] == [0, 10, 30]
