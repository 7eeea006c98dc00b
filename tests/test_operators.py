"""Properties and small cases of operators whose semantics need care."""

from __future__ import annotations

import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.operators import chips as C, match, nearest, planning, quality, splits, state, stats, windows
from eventloom.sources import scans


def ts(day: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def test_previous_overpass_is_distinct_and_before(spark):
    names = match.Names()
    t0 = spark.createDataFrame([(1, ts(10), 100, "o5")], "event_id long, t0_time timestamp, t0_product long, t0_overpass string")
    rows = [(100, ts(10), "o5"), (101, ts(9.99), "o5"), (102, ts(8), "o4"), (103, ts(8.001), "o4"), (104, ts(6), "o3"), (105, ts(1), "o1")]
    products = spark.createDataFrame(rows, "product_id long, acq_time timestamp, overpass string")
    got = [match.nth_previous_overpass(t0, products, names, "overpass", n, 20, "t0_time", "t0_product", "t0_overpass").collect() for n in (1, 2, 4)]
    assert [(r.overpass, r.product_id) for r in got[0]] == [("o4", 103)] and [(r.overpass, r.product_id) for r in got[1]] == [("o3", 104)] and got[2] == []


def test_as_of_is_strict_and_keeps_unmatched(spark):
    events = spark.createDataFrame([(1, "a", ts(1)), (2, "a", ts(0)), (3, "b", ts(5))], "event_id long, k string, ts timestamp")
    products = spark.createDataFrame([(7, "a", ts(0)), (9, "a", ts(0)), (8, "a", ts(1))], "product_id long, k string, acq_time timestamp")
    got = {r.event_id: r.product_id for r in match.latest_before(events, products, match.Names(keys=("k",))).collect()}
    assert got == {1: 7, 2: None, 3: None}


@pytest.mark.parametrize("km", [200.0, 1500.0])
def test_radius_join_equals_brute_force(spark, km):
    rng = np.random.default_rng(1)
    a = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(-90, 90, 60), rng.uniform(-180, 180, 60), strict=True))] + [(60, 89.9, 10.0), (61, -89.95, -170.0), (62, 0.0, 179.99)]
    b = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(-90, 90, 200), rng.uniform(-180, 180, 200), strict=True))] + [(200, 89.8, -170.0), (201, 0.0, -179.99), (202, -89.9, 20.0)]
    left, right = spark.createDataFrame(a, "pid long, lat double, lon double"), spark.createDataFrame(b, "oid long, olat double, olon double")
    got = {(r.pid, r.oid) for r in nearest.within_radius(left, right, km, degrees=3.0).collect()}

    def dist(p, q):
        u, v = np.radians([p[1], p[2]]), np.radians([q[1], q[2]])
        h = np.sin((v[0] - u[0]) / 2) ** 2 + np.cos(u[0]) * np.cos(v[0]) * np.sin((v[1] - u[1]) / 2) ** 2
        return 2 * 6371.0 * np.arcsin(min(1, np.sqrt(h)))

    assert got == {(p[0], q[0]) for p in a for q in b if dist(p, q) <= km}


def test_upsert_is_guarded_and_idempotent(spark):
    manifest = spark.createDataFrame([("a", "old.tif", "done"), ("b", None, "todo"), ("c", "", "todo")], "k string, path string, status string")
    updates = spark.createDataFrame([("a", 1, None, "failed"), ("b", 1, "x.tif", "done"), ("b", 2, "y.tif", "done"), ("c", 1, "nan", "failed"), ("z", 1, "q", "done")], "k string, seq int, path string, status string")
    once = state.guarded_upsert(manifest, updates, ["k"], "seq", "path", ["path", "status"])
    rows = {r.k: (r.path, r.status, r.changed) for r in once.collect()}
    assert rows == {"a": ("old.tif", "done", False), "b": ("y.tif", "done", True), "c": ("", "failed", True)}
    again = state.guarded_upsert(once.drop("changed"), updates, ["k"], "seq", "path", ["path", "status"])
    assert {r.k: (r.path, r.status) for r in again.collect()} == {k: v[:2] for k, v in rows.items()} and not any(r.changed for r in again.collect())


def test_versions(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    assert state.newest_version(spark, root) == -1
    state.write_version(spark.range(3), root)
    state.write_version(spark.range(5), root)
    assert state.read_version(spark, root).count() == 5 and state.read_version(spark, root, 0).count() == 3


def test_consensus_rules(spark):
    rows = [(1, True, True, 0), (2, True, False, 1), (3, False, False, 1), (4, True, None, 0), (5, None, None, 1)]
    df = spark.createDataFrame(rows, "i int, a boolean, b boolean, label int")
    run = lambda fix: {r.i: r.new_label for r in quality.consensus(df, {"A": "a", "B": "b"}, "label", fix).collect()}
    assert run(False) == {1: 1, 3: 1, 4: 0, 5: 1} and run(True) == {1: 1, 3: 0, 4: 1, 5: 1}


def test_splits_are_disjoint_and_stable(spark):
    df = spark.createDataFrame([(i, i % 37, ts(i % 11)) for i in range(500)], "id long, site long, at timestamp")
    for make in (lambda d: splits.hash_split(d, "site", 0.7), lambda d: splits.site_split(d, "site", "at", 0.7), lambda d: splits.site_split(d, "site", "at", 0.7, seed=3)):
        got = make(df)
        assert splits.leaks(got, "site").count() == 0 and got.count() == 500
        again = make(df.orderBy(F.desc("id")).repartition(7))
        assert {(r.id, r.split) for r in got.collect()} == {(r.id, r.split) for r in again.collect()}
        assert {r.split for r in got.select("split").distinct().collect()} == {"train", "test"}
    chrono = splits.chronological_split(df, "at", "id", 0.7)
    assert chrono.where("split = 'train'").count() == 350
    assert splits.hash_sample(df, "id", 40).count() == 40


def test_temporal_split_at_the_cutoffs(spark):
    days = [dt.date(2025, 7, 26), dt.date(2025, 7, 27), dt.date(2025, 7, 28), None]
    df = spark.createDataFrame([(d, ["S2"]) for d in days] + [(days[0], [])], "d date, s array<string>")
    assert [r.split for r in splits.temporal_split(df, "d", "s", "cutoff_no_gap").collect()] == ["train", "train", "test", "gap", "gap"]
    strict = spark.createDataFrame([(dt.date(2025, 5, 17), ["S2"]), (dt.date(2025, 5, 17), ["S2", "L89"]), (dt.date(2025, 5, 18), ["S2", "L89"])], "d date, s array<string>")
    assert [r.split for r in splits.temporal_split(strict, "d", "s", "strict").collect()] == ["gap", "gap", "test"]
    assert [r.split for r in splits.temporal_split(strict, "d", "s", "loose_test_priority").collect()] == ["gap", "test", "test"]
    with pytest.raises(ValueError):
        splits.temporal_split(df, "d", "s", "random")


def test_planning_validation(spark):
    with pytest.raises(ValueError):
        planning.work_rows(spark.createDataFrame([], "sensor string, timepoint string, action string"), "S2", ["download"], ["t9"])
    assert planning.slot_table(spark).count() == 24


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 0), (0.5, 1), (0.9, 1)], "s double, y int")
    assert stats.roc_auc(df, "s", "y").first().auc == pytest.approx(0.875)


def test_noisy_or_with_a_sure_one(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 1.0), (2, 0.1), (3, 0.0)], "k int, q double")
    assert {r.k: round(r.combined, 9) for r in stats.noisy_or(df, ["k"], "q").collect()} == {1: 0.75, 2: 1.0, 3: 0.0}


def chip(spark, a):
    return spark.createDataFrame([(a.shape[0], a.shape[1], [None if np.isnan(x) else float(x) for x in a.ravel()])], "height int, width int, px array<double>")


def test_chip_arithmetic(spark):
    a = np.arange(20, dtype=float).reshape(4, 5)
    df = chip(spark, a)
    got = df.select(C.crop("px", "height", "width", 1, 2, 2, 3).alias("c"), C.crop("px", "height", "width", 3, 0, 2, 2).alias("n"), C.crop_or_pad("px", "height", "width", 2).alias("p"), C.crop_or_pad("px", "height", "width", 6).alias("q")).first()
    assert got.c == a[1:3, 2:5].ravel().tolist() and got.n is None and got.p == a[1:3, 1:3].ravel().tolist()
    assert sum(got.q) == a.sum() and len(got.q) == 36


def test_resize_skips_unknown_pixels(spark):
    a = np.ones((4, 4))
    a[0, 0] = np.nan
    got = chip(spark, a).select(C.resize_known("px", 4, 4, 3, 3).alias("r"), C.share_missing("px").alias("m")).first()
    assert got.r[0] is None and all(x == pytest.approx(1.0) for x in got.r[1:]) and got.m == 1 / 16


def test_limits_of_crop_checks(spark):
    rows = [(1, 1, 0.20, 0.0, 5), (2, 1, 0.19, 0.25, 5), (3, 0, 0.0, 0.0, 1), (4, 1, 0.0, 0.26, 5)]
    df = spark.createDataFrame(rows, "k int, label int, z double, m double, n int")
    got = {r.k: (r.ok, r.reason) for r in quality.crop_checks(df, ["k"], "label", "z", "m", "n", 0.20, 0.25).collect()}
    assert got == {1: (False, "zero"), 2: (True, ""), 3: (False, "plume"), 4: (False, "missing")}


def test_npz_ingest(spark, tmp_path):
    buf = io.BytesIO()
    np.savez(buf, arr_0=np.arange(24, dtype=np.float32).reshape(3, 4, 2))
    (tmp_path / "a.npz").write_bytes(buf.getvalue())
    rows = scans.chips_of_arrays(spark.read.format("binaryFile").load(str(tmp_path))).orderBy("band").collect()
    assert [(r.band, r.height, r.width) for r in rows] == [(0, 3, 4), (1, 3, 4)] and rows[1].px[0] == 1.0


def test_running_total_over_ranges(spark):
    df = spark.createDataFrame([(i % 13, i, 1) for i in range(200)], "t long, i long, w long")
    got = {r.i: r.before for r in windows.running_total(df, "w", "t", ["i"]).collect()}
    order = sorted(range(200), key=lambda i: (i % 13, i))
    assert got == {i: k for k, i in enumerate(order)}


def test_rank_window(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert {(r.k, r.v) for r in windows.one_per_key(df, ["k"], ["v"]).collect()} == {("a", 1), ("b", 5)}
