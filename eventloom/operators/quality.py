"""Quality: file and chip checks, consensus of masks, alignment, audits."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.clean import has_value, null_if_sentinel, safe_double
from eventloom.operators.master import exists_in, wide_to_long
from eventloom.operators.windows import examples


def reasons(tests: Mapping[str, Column]) -> Column:
    """Q02, Q03: the names of the tests that hold, joined by semicolons; null where none does."""
    return F.nullif(F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests.items()])), ";"), F.lit(""))


def triplet_check(df: DataFrame, key: Sequence[str], paths: Sequence[str], chips: DataFrame, size: int) -> DataFrame:
    """Q01: each key's images: paths given, chips there, all of the size, one shape and type.

    chips: (path, height, width, dtype)."""
    long = df.select(*key, F.explode(F.array(*[null_if_sentinel(p, "path") for p in paths])).alias("path"))
    seen = long.join(chips, "path", "left").groupBy(*key).agg(
        F.count_if(F.col("path").isNull()).alias("n_blank"), F.count_if(F.col("path").isNotNull() & F.col("height").isNull()).alias("n_absent"),
        F.count_if((F.col("height") != size) | (F.col("width") != size)).alias("n_odd"), F.count_distinct("height", "width").alias("n_shapes"), F.count_distinct("dtype").alias("n_types"),
    )
    why = reasons({"missing_path": F.col("n_blank") > 0, "missing_file": F.col("n_absent") > 0, "wrong_size": F.col("n_odd") > 0, "mixed_shapes": F.col("n_shapes") > 1, "mixed_types": F.col("n_types") > 1})
    return seen.withColumn("reason", why).withColumn("ok", F.col("reason").isNull())


def s5p_check(df: DataFrame, paths: Sequence[str], iy: str, ix: str) -> DataFrame:
    """Q03: three paths and a numeric nearest pixel."""
    tests = {f"no_{p}": ~has_value(p, "path") for p in paths} | {"bad_nearest_index": safe_double(iy).isNull() | safe_double(ix).isNull()}
    return df.withColumn("reason", reasons(tests)).withColumn("ok", F.col("reason").isNull())


def verdicts(checks: DataFrame, event: str, raster: Sequence[str]) -> DataFrame:
    """Per event the valid sensors, their number, any valid, any valid raster sensor."""
    rows = checks.groupBy(event).agg(F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("sensor")))).alias("valid_sensors"))
    return rows.select(event, "valid_sensors", F.size("valid_sensors").alias("num_valid_sensors"), (F.size("valid_sensors") > 0).alias("any_ok"), F.arrays_overlap("valid_sensors", F.array(*[F.lit(s) for s in raster])).alias("raster_ok"))


def consensus(df: DataFrame, masks: Mapping[str, str], label: str, corrective: bool) -> DataFrame:
    """Q05, Q06: the label after the sensors' masks had their say, and why; conflicts go.

    masks: sensor -> column, true where its mask has plume pixels, false where none, null without mask.
    Two masks or more that agree on plume set 1; a conflict drops the row.  The corrective rules also
    let masks that agree on none set 0, and a single mask overrule the label.
    """
    states = F.array_compact(F.array(*[F.col(c) for c in masks.values()]))
    n, positive = F.size("_m"), F.size(F.filter("_m", lambda x: x))
    several, all_on, all_off = n >= 2, positive == n, positive == 0
    reason = (
        F.when(n == 0, "no_mask").when(several & all_on, "all_positive").when(several & all_off, "all_zero").when(several, "conflict")
        .when(all_on == (F.col(label) == 1), "single_consistent").otherwise("single_conflict")
    )
    value = F.when(several & all_on, 1).when(F.lit(corrective) & several & all_off, 0).when(F.lit(corrective) & (n == 1), all_on.cast("int")).otherwise(F.col(label))
    out = df.withColumn("_m", states).withColumn("consensus", reason).withColumn("new_label", value.cast("int"))
    return out.where("consensus <> 'conflict'").drop("_m")


def consensus_counts(df: DataFrame, masks: Mapping[str, str], label: str) -> DataFrame:
    """How many rows each rule meets, those dropped included."""
    states = F.array_compact(F.array(*[F.col(c) for c in masks.values()]))
    n, positive = F.size("_m"), F.size(F.filter("_m", lambda x: x))
    kind = F.when(n == 0, "no_mask").when((n >= 2) & (positive == n), "all_positive").when((n >= 2) & (positive == 0), "all_zero").when(n >= 2, "conflict").when((positive == 1) == (F.col(label) == 1), "single_consistent").otherwise("single_conflict")
    return df.withColumn("_m", states).groupBy(kind.alias("consensus")).agg(F.count("*").alias("n"))


def binarised(df: DataFrame, px: str) -> DataFrame:
    """Q07: mask pixels to 0 or 1 (finite and positive), and whether that changed any."""
    one = F.transform(px, lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (x > 0), 1.0).otherwise(0.0))
    same = F.forall(F.zip_with(px, one, lambda a, b: a.eqNullSafe(b)), lambda x: x)
    return df.withColumn("_one", one).withColumn("changed", ~same).withColumn(px, F.col("_one")).drop("_one")


def path_audit(df: DataFrame, key: Sequence[str], cells: Mapping[tuple[str, str], str], inventory: DataFrame, n: int = 20) -> DataFrame:
    """Q09: per sensor, distinct paths, missing ones and up to n examples."""
    paths = wide_to_long(df, key, cells).select("sensor", "path").distinct()
    seen = exists_in(paths, inventory, "path", "ok")
    counts = seen.groupBy("sensor").agg(F.count("*").alias("n_paths"), F.count_if(~F.col("ok")).alias("n_missing"))
    return counts.join(examples(seen.where("not ok"), "path", ["sensor"], n).select("sensor", "examples"), "sensor", "left")


def crop_checks(windows: DataFrame, key: Sequence[str], label: str, zero_ratio: str, missing_ratio: str, mask_pixels: str, most_zero: float, most_missing: float, zero_open: bool = False) -> DataFrame:
    """Q10: all timepoints of a window must pass; at the zero limit a window fails (zero_open: passes), over the
    missing limit it fails; a positive needs plume pixels, a negative none."""
    too_zero = F.col(zero_ratio) > most_zero if zero_open else F.col(zero_ratio) >= most_zero
    bad = F.when(too_zero, "zero").when(F.col(missing_ratio) > most_missing, "missing").when((F.col(label) == 1) & (F.col(mask_pixels) == 0), "no_plume").when((F.col(label) == 0) & (F.col(mask_pixels) > 0), "plume")
    return windows.withColumn("_bad", bad).groupBy(*key).agg(F.bool_and(F.col("_bad").isNull()).alias("ok"), F.array_join(F.array_sort(F.collect_set("_bad")), ";").alias("reason"))


def alignment(df: DataFrame, distance_m: Column, size: Column, expected: int, most_m: float) -> DataFrame:
    """Q11: centred, shifted or of the wrong size."""
    return df.withColumn("distance_m", distance_m).withColumn("alignment", F.when(size != expected, "size_mismatch").when(F.col("distance_m").isNull(), "unknown").when(F.col("distance_m") > most_m, "shifted").otherwise("centred"))


def issues(rules: Sequence[tuple[str, str, DataFrame, Column]]) -> DataFrame:
    """Q08: one table (severity, code, detail) from rules (severity, code, one-row metrics, detail; null: no issue)."""
    parts = [df.select(F.lit(s).alias("severity"), F.lit(c).alias("code"), d.cast("string").alias("detail")).where("detail is not null") for s, c, df, d in rules]
    return functools.reduce(DataFrame.unionByName, parts)


def require_none(found: DataFrame, severity: str = "error") -> None:
    """Q08, Q13: raises if there is an issue of the severity."""
    first = found.where(F.col("severity") == severity).limit(20).collect()
    if first:
        raise ValueError("; ".join(f"{r.code}: {r.detail}" for r in first))
