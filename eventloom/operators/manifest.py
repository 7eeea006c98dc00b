"""A manifest that grows by commits: rows in buckets of their key, of which a commit rewrites only those it touches.

Below the root, data/<id>/_bucket=<k>/ holds the files of one commit, log/<version>.json its record: the folder of every
bucket's rows, and the last batch taken from each stream.  A record appears whole or not at all, under a name that
only one writer gets, so readers always see one version, and of two writers that began with the same version one
raises.  Old versions stay readable until they are dropped.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventloom.operators.state import guarded_upsert


class CommitConflict(RuntimeError):
    """Another writer has made the next version since this one began."""


@dataclass
class Record:
    """What a version consists of."""

    version: int
    schema: str
    keys: list[str]
    n_buckets: int
    buckets: dict[str, str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change in milliseconds) of what stands in a folder; nothing if it isn't there."""
    fs, at = file_system(spark, path)
    return [(x.getPath().getName(), x.getModificationTime()) for x in fs.listStatus(at)] if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, record: Record) -> None:
    """Writes the record beside its place, then gives it its name, which must be free."""
    jvm = spark._jvm
    fs, temporary = file_system(spark, f"{root}/log/.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(json.dumps(record.__dict__).encode())
    out.close()
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/log/{record.version:020d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temporary.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(place), spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(temporary, False)
        if fs.exists(place):
            raise CommitConflict(f"version {record.version} of {root} was committed by another writer") from e
        raise


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that can be read, in order."""
    return sorted(int(n.removesuffix(".json")) for n, _ in _names(spark, f"{root}/log") if n.endswith(".json") and n[0] != ".")


def record(spark: SparkSession, root: str, version: int | None = None) -> Record:
    if version is None:
        known = versions(spark, root)
        if not known:
            raise FileNotFoundError(f"no version under {root}")
        version = known[-1]
    return Record(**json.loads(read_text(spark, f"{root}/log/{version:020d}.json")))


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(n)).cast("int")


def _rows(spark: SparkSession, root: str, of: Record, buckets: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(of.schema))
    paths = [f"{root}/{of.buckets[b]}/_bucket={b}" for b in buckets if b in of.buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the newest (or given) version."""
    of = record(spark, root, version)
    return _rows(spark, root, of, sorted(of.buckets))


def _write(df: DataFrame, root: str, keys: Sequence[str], n_buckets: int) -> dict[str, str]:
    """The rows' buckets, each in as many files as tasks that hold some of it: one, unless a task's share is large."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    rows = df.withColumn("_bucket", _bucket(keys, n_buckets)).repartition("_bucket")
    rows.write.partitionBy("_bucket").parquet(f"{root}/{folder}")
    return {n.split("=")[1]: folder for n, _ in _names(spark, f"{root}/{folder}") if n.startswith("_bucket=")}


def create(df: DataFrame, root: str, keys: Sequence[str], n_buckets: int = 64) -> int:
    """Version 0: the rows, in `n_buckets` buckets of a hash of `keys`.  Raises where there is a version already."""
    spark = df.sparkSession
    if versions(spark, root):
        raise CommitConflict(f"{root} has versions already")
    _commit(spark, root, Record(0, df.schema.json(), list(keys), n_buckets, _write(df, root, keys, n_buckets)))
    return 0


def rewrite(spark: SparkSession, root: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], stream: str | None = None, batch: int | None = None) -> int:
    """One commit on top of the newest version: `change` gives new rows for those of the buckets that hold a key of
    `touched`; other buckets stay as they are.  The new version's number.

    A batch of a stream that was taken before changes nothing and gives the newest version, so batches may be
    tried again.  Of two writers on one version the second raises CommitConflict, and leaves nothing behind."""
    of = record(spark, root)
    if stream is not None and of.streams.get(stream, -1) >= batch:
        return of.version
    hit = [str(r[0]) for r in touched.select(_bucket(of.keys, of.n_buckets)).distinct().collect()]  # as many as buckets at most
    new = _write(change(_rows(spark, root, of, hit)), root, of.keys, of.n_buckets) if hit else {}
    kept = {b: f for b, f in of.buckets.items() if b not in hit}
    streams = of.streams | ({stream: batch} if stream is not None else {})
    try:
        _commit(spark, root, Record(of.version + 1, of.schema, of.keys, of.n_buckets, kept | new, streams))
    except CommitConflict:
        for folder in set(new.values()):
            fs, at = file_system(spark, f"{root}/{folder}")
            fs.delete(at, True)
        raise
    return of.version + 1


def upsert(root: str, updates: DataFrame, seq: str, path: str, fields: Sequence[str], stream: str | None = None, batch: int | None = None, provenance: Sequence[str] = ()) -> int:
    """`guarded_upsert` of the newest version, of the buckets that have updates."""
    spark = updates.sparkSession
    keys = record(spark, root).keys
    return rewrite(spark, root, updates, lambda rows: guarded_upsert(rows, updates, keys, seq, path, fields, provenance=provenance).drop("changed"), stream, batch)


def drop_old(spark: SparkSession, root: str, grace_seconds: float) -> int:
    """Drops versions whose successor is older than the grace period, and data that no version left refers to and that is
    older too (a writer may still be at work on younger data).  How many versions went."""
    now = time.time() * 1000
    times = {int(n.removesuffix(".json")): t for n, t in _names(spark, f"{root}/log") if n.endswith(".json") and n[0] != "."}
    known = sorted(times)
    gone = [v for v, following in zip(known, known[1:], strict=False) if now - times[following] > grace_seconds * 1000]
    for v in gone:
        fs, at = file_system(spark, f"{root}/log/{v:020d}.json")
        fs.delete(at, False)
    used = {f for v in known if v not in gone for f in record(spark, root, v).buckets.values()}
    for name, t in _names(spark, f"{root}/data"):
        if f"data/{name}" not in used and now - t > grace_seconds * 1000:
            fs, at = file_system(spark, f"{root}/data/{name}")
            fs.delete(at, True)
    return len(gone)
