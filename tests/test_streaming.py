from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import manifest, state
from eventloom.streaming import jobs


def at(minutes: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


SCHEMA = "k string, seq int, path string"


def stream(spark, tmp_path, rows, root, mark="check", source="in"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{source}")
    jobs.upsert_stream(jobs.new_files(spark, f"{tmp_path}/{source}", SCHEMA), root, "seq", "path", ["path"], f"file://{tmp_path}/{mark}")


def paths(spark, root, version=None):
    return {r.k: r.path for r in manifest.read(spark, root, version).collect()}


def test_upsert_stream_applies_once(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    manifest.create(spark.createDataFrame([("a", None), ("b", None), (None, None)], "k string, path string"), root, ["k"], 4)
    stream(spark, tmp_path, [("a", 1, "x")], root)
    stream(spark, tmp_path, [("b", 1, "y"), ("a", 2, None), (None, 1, "n")], root)
    stream(spark, tmp_path, [("z", 1, "q")], root)
    assert paths(spark, root) == {"a": "x", "b": "y", None: None} and manifest.versions(spark, root) == [0, 1, 2, 3]


def test_stream_starts_from_the_newest_version(spark, tmp_path):
    """Versions 0, 1 and 2 stand there when the stream's first batch comes."""
    root = f"file://{tmp_path}/table"
    manifest.create(spark.createDataFrame([(k, None) for k in "123"], "k string, path string"), root, ["k"], 4)
    for k in "12":
        manifest.upsert(root, spark.createDataFrame([(k, 1, f"old{k}")], SCHEMA), "seq", "path", ["path"])
    stream(spark, tmp_path, [("3", 1, "new")], root)
    assert paths(spark, root) == {"1": "old1", "2": "old2", "3": "new"} and paths(spark, root, 1) == {"1": "old1", "2": None, "3": None}
    manifest.upsert(root, spark.createDataFrame([("1", 9, "other")], SCHEMA), "seq", "path", ["path"])
    stream(spark, tmp_path, [("2", 2, "more")], root)
    assert paths(spark, root) == {"1": "other", "2": "more", "3": "new"}
    stream(spark, tmp_path, [("3", 1, "again")], root, "another-check", "another-in")  # batch 0 of another stream
    assert paths(spark, root)["3"] == "again"


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    manifest.create(spark.createDataFrame([(str(i), None) for i in range(40)], "k string, path string"), root, ["k"], 8)
    updates = spark.createDataFrame([("7", 1, "x"), ("7", 1, "w"), ("8", 1, "y")], SCHEMA)
    assert manifest.upsert(root, updates, "seq", "path", ["path"], "s", 0) == 1
    before = manifest.record(spark, root)
    assert manifest.upsert(root, spark.createDataFrame([("7", 5, "late")], SCHEMA), "seq", "path", ["path"], "s", 0) == 1
    assert manifest.record(spark, root) == before and paths(spark, root)["7"] == "x"  # equal seq: the greater path
    first = manifest.record(spark, root, 0)
    assert 0 < sum(before.buckets[b] != first.buckets[b] for b in first.buckets) <= 2 and len(first.buckets) > 4  # others stay where they are
    assert manifest.upsert(root, updates.limit(0), "seq", "path", ["path"], "s", 1) == 2 and len(paths(spark, root)) == 40


def test_one_of_two_writers_raises(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    rows = spark.createDataFrame([("a", None), ("b", None)], "k string, path string")
    manifest.create(rows, root, ["k"], 2)

    def meanwhile(old):
        manifest.upsert(root, spark.createDataFrame([("a", 1, "first")], SCHEMA), "seq", "path", ["path"])
        return old

    with pytest.raises(manifest.CommitConflict):
        manifest.rewrite(spark, root, rows, meanwhile)
    assert paths(spark, root) == {"a": "first", "b": None} and manifest.versions(spark, root) == [0, 1]
    used = {f for v in (0, 1) for f in manifest.record(spark, root, v).buckets.values()}
    assert {f"data/{p.name}" for p in (tmp_path / "table" / "data").iterdir() if not p.name.startswith(".")} == used
    with pytest.raises(manifest.CommitConflict):
        manifest.create(rows, root, ["k"])


def test_old_versions_are_dropped_after_their_time(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    manifest.create(spark.createDataFrame([("a", None), ("b", None)], "k string, path string"), root, ["k"], 2)
    for i in range(3):
        manifest.upsert(root, spark.createDataFrame([("a", i, f"p{i}")], SCHEMA), "seq", "path", ["path"])
    assert manifest.drop_old(spark, root, 3600) == 0 and len(manifest.versions(spark, root)) == 4
    assert manifest.drop_old(spark, root, -1) == 3 and manifest.versions(spark, root) == [3]
    assert paths(spark, root) == {"a": "p2", "b": None}
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, f"{root}-none")


def test_provenance_changes_where_the_path_is_guarded(spark):
    old = spark.createDataFrame([("a", "good", "done"), ("b", None, "new")], "k string, path string, status string")
    updates = spark.createDataFrame([("a", 1, None, "failed"), ("b", 1, "got", "")], "k string, seq int, path string, status string")
    got = state.guarded_upsert(old, updates, ["k"], "seq", "path", ["path"], provenance=["status"]).collect()
    assert {(r.k, r.path, r.status, r.changed) for r in got} == {("a", "good", "failed", True), ("b", "got", "new", True)}


def test_resume_checks_the_manifest(spark, tmp_path):
    source, out, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    schema = "id long, v string"
    rows = [(i, f"v{i}") for i in range(10)]

    def go(part, whole):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        jobs.run_guarded(jobs.new_files(spark, source, schema).writeStream.format("parquet").option("path", out), f"file://{mark}", spark.createDataFrame(whole, schema), "id")

    def found():
        return sorted(r.id for r in spark.read.schema(schema).parquet(out).collect())

    go(rows[:6], rows[:6])
    go(rows[6:8], rows[:8])  # appended: goes on
    assert found() == list(range(8))
    for other in (rows[:3] + [(3, "changed")] + rows[4:9], rows[:2] + rows[3:9], rows[:7]):
        with pytest.raises(jobs.ManifestMismatch):
            go(rows[8:9], other)
        assert found() == list(range(8))


def memory(df, name, checkpoint, mode="append"):
    jobs.run_available(df.writeStream.format("memory").queryName(name).outputMode(mode), checkpoint)
    return df.sparkSession.table(name)


def test_usage_once(spark, tmp_path):
    schema = "k string, at timestamp"
    source = f"{tmp_path}/in"
    spark.createDataFrame([("a", at(0)), ("a", at(1)), ("b", at(2))], schema).coalesce(1).write.parquet(source)
    once = jobs.usage_once(jobs.new_files(spark, source, schema), "at", "10 minutes", ["k"])
    out = memory(once, "usage", f"file://{tmp_path}/check")
    assert sorted(r.k for r in out.collect()) == ["a", "b"]


def test_gate_stream(spark, tmp_path):
    schema = "event string, timepoint string, ok boolean, at timestamp"
    source = f"{tmp_path}/in"
    rows = [("e1", "prev1", True, at(0)), ("e1", "t0", True, at(1)), ("e2", "t0", False, at(2)), ("e2", "year", True, at(3))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    gated = jobs.t0_gate_stream(jobs.new_files(spark, source, schema), "event", "at", "1 hour", 60_000)
    out = memory(gated, "gate", f"file://{tmp_path}/check")
    assert {(r.event, r.timepoint, r.gate) for r in out.collect()} == {("e1", "t0", "t0_ok"), ("e1", "prev1", "proceed"), ("e2", "t0", "t0_failed"), ("e2", "year", "skip_t0_failed")}


def test_gate_gives_up_without_t0(spark, tmp_path):
    schema = "event string, timepoint string, ok boolean, at timestamp"
    source = f"{tmp_path}/in"
    rows = [("e1", "prev1", True, at(0)), ("e1", "year", True, at(1)), ("e2", "prev1", True, at(2)), ("e2", "t0", True, at(3)), ("e9", "t0", True, at(600))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    gated = jobs.t0_gate_stream(jobs.new_files(spark, source, schema), "event", "at", "1 hour", 60_000)
    out = memory(gated, "late", f"file://{tmp_path}/check")
    assert {(r.event, r.timepoint, r.gate) for r in out.collect()} == {("e1", "prev1", "skip_t0_failed"), ("e1", "year", "skip_t0_failed"), ("e2", "t0", "t0_ok"), ("e2", "prev1", "proceed"), ("e9", "t0", "t0_ok")}


def test_gate_handles_many_events_at_once(spark, tmp_path):
    """Python and the state have slices of the events, not an event each; rows of no event have no t0."""
    schema = "event string, timepoint string, ok boolean, at timestamp"
    source = f"{tmp_path}/in"
    n = 2000
    others = [(str(i), t, True, at(i % 7)) for i in range(n) for t in ("prev1", "year")] + [(None, "prev1", True, at(1))]
    t0s = [(str(i), "t0", None if i % 3 == 0 else i % 3 == 1, at(8)) for i in range(n) if i % 5] + [(None, "t0", True, at(8))]
    late = [(str(i), "next", True, at(9)) for i in range(0, n, 2)]
    for rows in (others, t0s, late, [("clock", "t0", True, at(6000))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    gated = jobs.t0_gate_stream(jobs.new_files(spark, source, schema, files_per_batch=1), "event", "at", "1 hour", 3_600_000)
    query = jobs.run_available(gated.writeStream.format("memory").queryName("many").outputMode("append"), f"file://{tmp_path}/check")
    want = [("clock", "t0", "t0_ok"), (None, "t0", "t0_ok"), (None, "prev1", "skip_t0_failed")]
    for i in range(n):
        passed = i % 5 > 0 and i % 3 == 1
        want += [(str(i), t, "proceed" if passed else "skip_t0_failed") for t in ("prev1", "year", *["next"] * (i % 2 == 0))]
        want += [(str(i), "t0", "t0_ok" if passed else "t0_failed")] * (i % 5 > 0)
    assert sorted((r.event or "", r.timepoint, r.gate) for r in spark.table("many").collect()) == sorted((e or "", t, g) for e, t, g in want)
    kept = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert 0 < max(kept) <= 256 and kept[-1] == 1


def test_stream_match(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    spark.createDataFrame([(1, "k", at(0)), (2, "k", at(600))], "event_id long, k string, ts timestamp").coalesce(1).write.parquet(a)
    spark.createDataFrame([(7, "k", at(20)), (8, "j", at(0))], "product_id long, k string, acq timestamp").coalesce(1).write.parquet(b)
    pairs = jobs.match_streams(jobs.new_files(spark, a, "event_id long, k string, ts timestamp"), jobs.new_files(spark, b, "product_id long, k string, acq timestamp"), "k", "ts", "acq", "1 hour", "1 hour")
    out = memory(pairs, "pairs", f"file://{tmp_path}/check")
    assert [(r.event_id, r.product_id) for r in out.collect()] == [(1, 7)]


def test_counts(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.createDataFrame([("s", at(0)), ("s", at(5)), ("f", at(15))], "status string, at timestamp").coalesce(1).write.parquet(source)
    counts = jobs.status_counts(jobs.new_files(spark, source, "status string, at timestamp"), "at", "status")
    out = memory(counts, "counts", f"file://{tmp_path}/check", "update")
    assert sorted((r.status, r.n) for r in out.select("status", F.col("n")).collect()) == [("f", 1), ("s", 2)]
