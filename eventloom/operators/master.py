"""One record per event from several sensors' tables; look-ups, existence, wide and long forms."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from eventloom.functions.clean import has_value, null_if_sentinel
from eventloom.operators.windows import one_per_key


def outer_merge(sides: Mapping[str, DataFrame], key: str, order: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Full outer join on the key of one row per key and side (the first in `order`, then by all columns, so no
    tie is left to chance); columns get the side's prefix.

    All joins share one partitioning by key."""
    out = None
    for name, df in sides.items():
        first = list((order or {}).get(name, ()))
        one = one_per_key(df, [key], [*first, *[c for c in df.columns if c != key and c not in first]] or [key])
        one = one.select(key, *[F.col(c).alias(f"{name}_{c}") for c in one.columns if c != key])
        out = one if out is None else out.join(one, key, "full_outer")
    return out


def unify(df: DataFrame, shared: Sequence[str], sides: Sequence[str]) -> DataFrame:
    """Each shared column from the first side that has it; the sides' copies go."""
    copies = [f"{s}_{c}" for s in sides for c in shared if f"{s}_{c}" in df.columns]
    return df.select(*[c for c in df.columns if c not in copies], *[F.coalesce(*[F.col(f"{s}_{c}") for s in sides if f"{s}_{c}" in df.columns]).alias(c) for c in shared])


def lookup(df: DataFrame, table: DataFrame, key: str, order: Sequence[str], prefix: str = "") -> DataFrame:
    """Left join to one row per key; an empty table gives nulls."""
    one = one_per_key(table, [key], order)
    return df.join(one.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in one.columns if c != key]), key, "left")


def inner_best(df: DataFrame, matches: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Inner join to each key's best match."""
    return df.join(one_per_key(matches, [key], order), key)


def join_natural(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on many columns, where null equals null."""
    right = b.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return a.join(right, on, how).drop(*[f"_{k}" for k in keys])


def not_done(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work whose keys aren't done."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def new_known(ids: DataFrame, raw: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Ids not in raw, but in the catalogue."""
    return ids.join(raw.select(key), key, "left_anti").join(catalogue.select(key), key, "left_semi")


def with_membership(df: DataFrame, sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """A flag for each set that has the key."""
    for name, s in sets.items():
        df = df.join(s.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def overlay(df: DataFrame, previous: DataFrame, key: str, seq: str, fields: Sequence[str], profile: str = "manifest") -> DataFrame:
    """The last earlier result of each key fills in where it has values."""
    last = one_per_key(previous, [key], [F.col(seq).desc()]).select(key, *[null_if_sentinel(f, profile).alias(f"_{f}") for f in fields])
    joined = df.join(last, key, "left")
    return joined.select(*[F.coalesce(f"_{c}", F.col(c).cast("string")).alias(c) if c in fields else F.col(c) for c in df.columns])


def exists_in(df: DataFrame, files: DataFrame, path: str, flag: str) -> DataFrame:
    """Whether the path names a non-empty file of an inventory (path, length)."""
    good = files.where("length > 0").select(F.col("path").alias("_path")).distinct().withColumn(flag, F.lit(True))
    return df.join(good, F.col(path) == F.col("_path"), "left").drop("_path").withColumn(flag, F.coalesce(flag, F.lit(False)))


def first_existing(df: DataFrame, files: DataFrame, key: str, candidates: Sequence[str], name: str) -> DataFrame:
    """Of several path columns, in order, the first that exists, and which it was."""
    long = df.select(key, F.posexplode(F.array(*[F.struct(F.lit(c).alias("kind"), null_if_sentinel(c, "path").alias("path")) for c in candidates])).alias("priority", "x")).select(key, "priority", "x.*").where("path is not null")
    best = exists_in(long, files, "path", "_ok").where("_ok").groupBy(key).agg(F.min_by(F.struct("path", "kind"), "priority").alias("_b")).select(key, F.col("_b.path").alias(name), F.col("_b.kind").alias(f"{name}_from"))
    return df.join(best, key, "left")


def first_valid_place(rows: DataFrame, key: Sequence[str], priority: str, valid: Column, tie: str) -> DataFrame:
    """Per key the valid row of least priority."""
    rest = [c for c in rows.columns if c not in key]
    return rows.where(valid).groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(priority, tie)).alias("_b")).select(*key, *[F.col("_b")[c].alias(c) for c in rest])


def complete_triplets(df: DataFrame, slots: Mapping[str, Sequence[str]]) -> DataFrame:
    """adds valid_sensors and keeps events with one complete sensor at least."""
    whole = {s: functools.reduce(operator.and_, [has_value(c, "path") for c in cols]) for s, cols in slots.items()}
    found = F.array_compact(F.array(*[F.when(ok, F.lit(s)) for s, ok in whole.items()]))
    return df.withColumn("valid_sensors", found).where(F.size("valid_sensors") > 0)


def invalidate_cloudy(df: DataFrame, slots: Mapping[str, tuple[str, Sequence[str]]], most: float, null_ok: bool = True) -> DataFrame:
    """nulls a slot's columns where its cloud is over `most`; counts what is left and keeps rows with any.

    slots: name -> (cloud column, columns of the slot; the first says whether it is there)."""
    values, counts = {}, []
    for cloud, columns in slots.values():
        ok = F.coalesce(F.col(cloud) <= most, F.lit(null_ok)) & F.col(columns[0]).isNotNull()
        counts.append(ok.cast("int"))
        values |= {c: F.when(ok, F.col(c)) for c in columns}
    n = functools.reduce(operator.add, counts).alias("n_valid")
    return df.select(*[values.get(c, F.col(c)).alias(c) for c in df.columns], n).where("n_valid > 0")


def wide_to_long(df: DataFrame, key: Sequence[str], cells: Mapping[tuple[str, str], str]) -> DataFrame:
    """Path columns to rows (sensor, timepoint, path); empty ones are left out."""
    rows = F.array(*[F.struct(F.lit(s).alias("sensor"), F.lit(t).alias("timepoint"), null_if_sentinel(c, "path").alias("path")) for (s, t), c in cells.items()])
    return df.select(*key, F.explode(rows).alias("_x")).select(*key, "_x.*").where("path is not null")


def long_to_wide(df: DataFrame, key: Sequence[str], column: str, values: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """Rows to columns value_field; of several rows the first in `order`. Values are given, so there is no extra pass."""
    cells = [F.min_by(F.when(F.col(column) == v, F.col(f)), F.when(F.col(column) == v, F.col(order))).alias(f"{v}_{f}") for v in values for f in fields]
    return df.groupBy(*key).agg(*cells)


def two_labels(df: DataFrame, keep: Sequence[str], positive: Sequence[str], negative: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A row with a positive and a negative half to two labelled rows."""
    half = lambda label, cols: F.struct(F.lit(label).alias("label"), *[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)])
    return df.select(*keep, F.inline(F.array(half(1, positive), half(0, negative))))


def request_groups(df: DataFrame, group: Sequence[str], hour: str, slot: str) -> DataFrame:
    """Requests collapsed to one per group, with its hours and slots."""
    return df.groupBy(*group).agg(F.array_sort(F.collect_set(hour)).alias("hours"), F.array_sort(F.collect_set(slot)).alias("slots"), F.count("*").alias("n_requests"))


def combine_evidence(planned: DataFrame, observed: DataFrame, keys: Sequence[str], flags: Sequence[str], time: str, seq: str, evidence: str) -> DataFrame:
    """Planned and observed rows to one per key: any flag, all evidence, the time of the last row that has one."""
    rows = planned.unionByName(observed, allowMissingColumns=True)
    return rows.groupBy(*keys).agg(*[F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags], F.array_sort(F.collect_set(evidence)).alias(evidence), F.max_by(time, F.when(F.col(time).isNotNull(), F.col(seq))).alias(time))


def site_last_time(df: DataFrame, site: str, time: str) -> DataFrame:
    """Adds the site's last time."""
    return df.withColumn("site_last", F.max(time).over(Window.partitionBy(site)))


def with_any(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows in which any of the columns has a value (t0 paths or flags, say)."""
    return df.where(functools.reduce(operator.or_, [has_value(c, "manifest") for c in columns]))
