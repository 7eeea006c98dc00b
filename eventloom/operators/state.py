"""Manifest state: guarded upserts, completed keys, reconciliation, caches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.clean import has_value, null_if_sentinel
from eventloom.operators.windows import one_per_key

KEYS = ("sensor", "event_id", "timepoint")


def _last(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Each key's last row by `seq`; equal ones by all other columns, so none is left to chance."""
    rest = [c for c in rows.columns if c != seq and c not in keys]
    return one_per_key(rows, keys, [F.col(seq).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rest]])


def guarded_upsert(manifest: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str, path: str, fields: Sequence[str], protected: Column | None = None, provenance: Sequence[str] = ()) -> DataFrame:
    """The last update of each key, by `seq` (then by all columns), overwrites its non-empty fields.

    A row whose `path` has a value (or that `protected` says) isn't changed by an update without one, but in its
    `provenance` fields (status, message, source).  Adds `changed`.  Updates of unknown keys are left out, a null key
    is unknown; running it twice changes nothing more.
    """
    own = [*fields, *[p for p in provenance if p not in fields]]
    last = _last(updates, keys, seq)
    last = last.select(*keys, F.lit(True).alias("_has"), *[null_if_sentinel(f, "manifest").alias(f"_{f}") for f in own])
    joined = manifest.join(last, list(keys), "left")
    good = has_value(path, "manifest") if protected is None else protected
    has = F.coalesce(F.col("_has"), F.lit(False))
    takes = {f: has if f in provenance else has & ~(good & F.col(f"_{path}").isNull()) for f in own}
    values = {f: F.when(takes[f], F.coalesce(F.col(f"_{f}"), F.col(f).cast("string"))).otherwise(F.col(f).cast("string")) for f in own}
    changed = F.exists(F.array(*[takes[f] & ~F.col(f"_{f}").eqNullSafe(F.col(f).cast("string")) & F.col(f"_{f}").isNotNull() for f in own]), lambda x: x)
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in manifest.columns], changed.alias("changed"))


def completed(records: DataFrame, keys: Sequence[str], path: str, seq: str, inventory: DataFrame | None = None) -> DataFrame:
    """The last record of each key that has a path (of a non-empty file, given an inventory); ties in `seq` end by all
    columns."""
    rows = records.where(has_value(path, "manifest"))
    if inventory is not None:
        rows = rows.join(inventory.where("length > 0").select(F.col("path").alias(path)).distinct(), path, "left_semi")
    return _last(rows, keys, seq)


def mapped_updates(records: DataFrame, mapping: Mapping[str, Column | str], accept: Column) -> DataFrame:
    """Accepted records as updates: target column -> source column, empty values null."""
    return records.where(accept).select(*[(null_if_sentinel(c, "manifest") if isinstance(c, str) else c).alias(t) for t, c in mapping.items()])


def pull_status(files: DataFrame, targets: DataFrame, done: DataFrame, inventory: DataFrame, name: str) -> DataFrame:
    """What to do with each listed file: unplanned, resume, existing valid, mismatch, or download.

    targets: (name, expected_length); done: (name); inventory: (name, length)."""
    rows = files.join(targets.select(name, "expected_length"), name, "left")
    rows = rows.join(done.select(name).distinct().withColumn("_done", F.lit(True)), name, "left")
    rows = rows.join(inventory.groupBy(name).agg(F.max("length").alias("_length")), name, "left")
    status = (
        F.when(F.col("expected_length").isNull(), "unplanned").when(F.col("_done"), "resume_done").when(F.col("_length").isNull(), "download")
        .when(F.col("_length") == F.col("expected_length"), "existing_valid").otherwise("existing_mismatch")
    )
    return rows.withColumn("status", status).drop("_done", "_length")


def append_usage(log: DataFrame, more: DataFrame, keys: Sequence[str] = ("event_id", "timepoint", "path")) -> DataFrame:
    """The rows of `more` with keys the log doesn't have, one each."""
    return more.dropDuplicates(list(keys)).join(log.select(*keys), list(keys), "left_anti")


def through_cache(requests: DataFrame, group: Sequence[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """One request per group (the first by seq) to be answered, and the keys to join the answers back by."""
    return one_per_key(requests, group, [seq]), requests


def resume_point(output: DataFrame, row: str, key: str) -> DataFrame:
    """The highest row and id written so far, -1 and 0 for none."""
    return output.agg(F.coalesce(F.max(row), F.lit(-1)).alias("last_row"), F.coalesce(F.max(key), F.lit(0)).alias("last_id"))


def stack_offsets(chips: DataFrame, key: Sequence[str], offset: str, values: Sequence[int], px: str) -> DataFrame:
    """Chips of one key at several offsets as an array of arrays, where all are there."""
    cells = [F.max(F.when(F.col(offset) == v, F.col(px))).alias(f"_{i}") for i, v in enumerate(values)]
    wide = chips.groupBy(*key).agg(*cells)
    return wide.dropna(subset=[f"_{i}" for i in range(len(values))]).select(*key, F.array(*[F.col(f"_{i}") for i in range(len(values))]).alias("stack"))


def write_version(df: DataFrame, root: str) -> int:
    """Writes the next version of a table under root; readers take the newest complete one."""
    n = newest_version(df.sparkSession, root) + 1
    df.write.parquet(f"{root}/version={n}")
    return n


def newest_version(spark: SparkSession, root: str) -> int:
    """The newest version under root whose write is complete (its _SUCCESS file is there); -1 for none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    found = [x.getPath() for x in fs.listStatus(path) if x.getPath().getName().startswith("version=")]
    done = [int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(done, default=-1)


def read_version(spark: SparkSession, root: str, n: int | None = None) -> DataFrame:
    """The newest (or given) version of the table under root."""
    n = newest_version(spark, root) if n is None else n
    if n < 0:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root}/version={n}")
