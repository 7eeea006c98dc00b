"""The release manifests of the report, and the numbers they must give."""

from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F

from eventloom.functions import clean
from eventloom.operators import quality, report, splits
from eventloom.sources import scans, sinks

FIELDS = "event_id,id,label,latitude,longitude,event_time,available_sensor,S2_t0_path,L89_t0_path,EMIT_t0_path,S5p_temporal_path".split(",")
#: Seven wells; the last is not released, the fifth has three sensors, one spells its sensors its own way.
ROWS = [
    ["well-17", "17", "0", "-12.04", "77.03", "2023-08-11T06:30:00Z", "EMIT", "", "", "w17/emit.nc", ""],
    ["well-18", "18", "1", "60.17", "24.94", "2023-08-12T07:31:00Z", "sentinel-2", "w18/s2.tif", "", "", ""],
    ["well-21", "21", "1", "1.29", "103.85", "2023-09-01T03:00:10Z", "L89 EMIT", "", "w21/l9.tif", "w21/emit.nc", ""],
    ["well-22", "22", "0", "-33.45", "-70.67", "2023-09-02T14:45:00Z", "S5P", "", "", "", "w22/s5p.nc"],
    ["well-30", "30", "1", "19.43", "-99.13", "2023-10-09T17:05:30Z", "S2,L89,S5P", "w30/s2.tif", "w30/l8.tif", "", "w30/s5p.nc"],
    ["well-31", "31", "0", "64.15", "-21.94", "2023-10-10T12:12:12Z", "L89", "", "w31/l8.tif", "", ""],
    ["well-44", "44", "1", "-1.29", "36.82", "2023-11-20T08:00:00Z", "S2", "w44/s2.tif", "", "", ""],
]


@pytest.fixture(scope="module")
def manifests(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("manifests")
    out = {}
    for name, rows in {"source": ROWS, "release": ROWS[:6], "train": ROWS[:3], "test": ROWS[3:6]}.items():
        with (folder / f"{name}.csv").open("w", newline="", encoding="utf-8-sig") as f:
            csv.writer(f).writerows([FIELDS, *rows])
        out[name] = scans.manifest(spark, str(folder / f"{name}.csv")).withColumn("sensors", clean.sensor_list("available_sensor"))
    return out


def test_clean_release(manifests):
    assert manifests["release"].columns[0] == "event_id"  # no byte-order mark
    delta = report.filtering(manifests["source"], manifests["release"], "event_id", 7, 6).first()
    assert (delta.removed_events, delta.unknown_events, delta.counts_as_expected) == (1, 0, True)
    assert {r.sensor: r.n for r in report.sensor_rows(manifests["release"], "sensors").collect()} == {"EMIT": 2, "L89": 3, "S2": 2, "S5P": 2}
    assert {r.pattern: r.n for r in report.patterns(manifests["release"], "sensors").collect()} == {"EMIT": 1, "EMIT+L89": 1, "L89": 1, "L89+S2+S5P": 1, "S2": 1, "S5P": 1}
    s = report.summary(manifests["release"], "event_id", "latitude", "longitude", "event_time").first()
    assert (s.n_rows, s.unique_events, s.missing_events, s.invalid_coordinates, s.invalid_datetime) == (6, 6, 0, 0, 0)


def leak_issues(train, test):
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    found = splits.leaks(both, "event_id").agg(F.count("*").alias("n"))
    return quality.issues([("error", "event_leakage", found, F.when(F.col("n") > 0, F.col("n")))])


def test_leakage(spark, manifests):
    none = leak_issues(manifests["train"], manifests["test"])
    assert none.count() == 0
    metrics = report.metrics_long({"release": report.summary(manifests["release"], "event_id")})
    lines = [r.line for r in report.as_markdown(metrics, none).orderBy("place").collect()]
    assert any("No manifest-level validation issues" in x for x in lines)
    leaky = manifests["release"].where("event_id in ('well-21', 'well-31')")
    found = leak_issues(manifests["train"], leaky).collect()
    assert [(r.code, r.detail) for r in found] == [("event_leakage", "1")]
    with pytest.raises(ValueError, match="event_leakage"):
        quality.require_none(leak_issues(manifests["train"], leaky))


def test_samples(manifests):
    paths = {"S2": {"t0": "S2_t0_path"}, "L89": {"t0": "L89_t0_path"}}
    r = scans.samples(manifests["release"], ["S2", "L89"], "available_sensor", paths).where("id = '30'").first()
    assert sorted(r.sensors) == ["L89", "S2"] and r.sensor_paths["L89"]["t0"] == "w30/l8.tif" and r.label == 1


def test_unknown_split_raises(spark):
    with pytest.raises(ValueError, match="scheme"):
        scans.released_split(spark.range(1), "random", 120, "train")


def test_manifest_round_trip(spark, manifests, tmp_path):
    sinks.write_manifest(manifests["release"], str(tmp_path / "out"), ["event_id", "absent", "label"])
    back = scans.manifest(spark, str(tmp_path / "out"))
    assert back.columns == ["event_id", "absent", "label"] and back.count() == 6
    assert scans.lookup_or_empty(spark, str(tmp_path / "none.csv"), "a string, b string").count() == 0
