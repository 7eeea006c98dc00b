from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from eventloom.functions import clean, geo, names, temporal


def values(spark, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, "c string").select(*columns).collect()]


def test_null_spellings(spark):
    data = [(" NaN ",), ("None",), ("<NA>",), ("null",), ("",), (None,), (" x ",)]
    got = values(spark, data, clean.null_if_sentinel("c", "report"), clean.null_if_sentinel("c", "manifest"), clean.clean_text("c", "path"))
    assert got == [(None, None, ""), (None, None, "None"), ("<NA>", None, "<NA>"), (None, None, "null"), (None, None, ""), (None, None, ""), ("x", "x", "x")]


def test_numbers_and_bools(spark):
    data = [("1.5",), ("nan",), ("1_000",), ("",), ("yes",), ("T",), (None,)]
    got = values(spark, data, clean.safe_double("c"), clean.number_flaw("c"), clean.text_bool("c"), clean.text_bool("c", "short"))
    assert got == [(1.5, None, False, False), (None, "missing", False, False), (None, "invalid", False, False), (None, "missing", False, False), (None, "invalid", True, True), (None, "invalid", False, True), (None, "missing", False, False)]


def test_sensor_lists(spark):
    data = [("S2, landsat-8",), ("Sentinel-5P;emit",), ("moon",), (None,)]
    assert values(spark, data, clean.sensor_list("c")) == [(["L89", "S2"],), (["EMIT", "S5P"],), ([],), ([],)]
    df = spark.createDataFrame([(None, "a.tif", None)], "s string, s2_path string, l_path string")
    assert df.select(clean.sensors_or_paths("s", {"S2": ["s2_path"], "L89": ["l_path"]})).first()[0] == ["S2"]


def test_hash_fraction(spark):
    want = int(hashlib.md5(b"e1").hexdigest()[:8], 16) / 0xFFFFFFFF
    assert values(spark, [("e1",)], clean.hash_fraction("c"))[0][0] == pytest.approx(want, abs=1e-15)


def test_times(spark):
    data = [("2025-01-01T00:00:00Z",), ("2025-13-01",), ("bad",), ("2025-01-01 junk",), ("2025",), ("2025-06-01 10:29:59.5+00",), (None,)]
    got = values(spark, data, temporal.valid_datetime("c"), temporal.iso_z(temporal.parse_utc("c")), temporal.iso_z(temporal.round_hour(temporal.parse_utc("c"))))
    assert [g[0] for g in got] == [True, False, False, True, False, True, False]
    assert got[0][1:] == ("2025-01-01T00:00:00Z", "2025-01-01T00:00:00Z") and got[5][1:] == ("2025-06-01T10:29:59Z", "2025-06-01T10:00:00Z")
    assert values(spark, [("2025-06-01T10:30:00Z",)], temporal.iso_z(temporal.round_hour(temporal.parse_utc("c"))))[0][0] == "2025-06-01T11:00:00Z"
    assert values(spark, [("EMIT_L2A_RFL_001_20240203T101112_x",)], temporal.stamp_in_name("c"))[0][0] == dt.datetime(2024, 2, 3, 10, 11, 12)


def test_distances_and_boxes(spark):
    one = spark.range(1)
    km = one.select(geo.haversine_km(F.lit(0.0), F.lit(179.5), F.lit(0.0), F.lit(-179.5)), geo.flat_km(F.lit(0.0), F.lit(179.5), F.lit(0.0), F.lit(-179.5))).first()
    assert km[0] == pytest.approx(math.radians(1) * 6371, rel=1e-9) and km[1] == pytest.approx(km[0], rel=1e-9)
    b = geo.box(F.lit(170.0), F.lit(-10.0), F.lit(-170.0), F.lit(10.0))
    got = one.select(geo.in_box(F.lit(0.0), F.lit(-175.0), b), geo.in_box(F.lit(0.0), F.lit(0.0), b), geo.lon180(F.lit(-190.0)), geo.lon360(F.lit(-1.0))).first()
    assert tuple(got) == (True, False, 170.0, 359.0)


def test_bounds_text(spark):
    df = spark.createDataFrame([("[1,2,3,4]", 0.0, 0.0), ("[1,2]", 5.0, 6.0), (None, 5.0, 6.0)], "b string, lat double, lon double")
    got = [tuple(r[0]) for r in df.select(geo.parse_bounds("b", "lat", "lon")).collect()]
    assert got[0] == (1, 2, 3, 4) and got[1] == got[2] == (5.99, 4.99, 6.01, 5.01)


def test_names(spark):
    assert values(spark, [("p-AB",), ("p-1",)], names.group_id("c")) == [("p",), ("p-1",)]
    assert values(spark, [("1,2; 3 ,4;x,5",)], names.encode_centers(names.parse_centers("c"))) == [("1,2;3,4",)]
    swath = values(spark, [("S5P_OFFL_L2__CH4____20240101T000000_20240101T010000_32145_03_x.nc",)], names.swath_fields("c"))[0][0]
    assert (swath.proc, swath.orbit, swath.t_end) == ("OFFL", 32145, dt.datetime(2024, 1, 1, 1))
    scene = values(spark, [("LC08_L2SP_042034_20200101_20200114_02_T1",)], names.scene_fields("c"))[0][0]
    assert (scene.wrs_path, scene.wrs_row, scene.acquired) == ("042", "034", dt.date(2020, 1, 1))
