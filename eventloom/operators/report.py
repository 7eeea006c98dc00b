"""Manifest reports: counts, availability, split audits, filtering deltas, their documents."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions import geo, temporal
from eventloom.functions.clean import has_value, null_if_sentinel


def summary(df: DataFrame, event: str, lat: str | None = None, lon: str | None = None, time: str | None = None, profile: str = "report") -> DataFrame:
    """One row: rows, distinct and missing events, events of several rows, flaws of coordinates and times.

    Rows are aggregated per event first, so the distinct count costs no extra pass."""
    cells: dict[str, Column] = {"n_rows": F.lit(1)}
    if lat and lon:
        flaw = lambda c, limit: geo.coordinate_flaw(c, limit, profile)
        a, b = flaw(lat, 90), flaw(lon, 180)
        cells["missing_coordinates"] = ((a == "missing") | (b == "missing")).cast("int")
        cells["invalid_coordinates"] = (a.isin("unparsable", "out_of_range") | b.isin("unparsable", "out_of_range")).cast("int")
    if time:
        cells["missing_datetime"] = (~has_value(time, profile)).cast("int")
        cells["invalid_datetime"] = (has_value(time, profile) & ~temporal.valid_datetime(time)).cast("int")
    per_event = df.select(null_if_sentinel(event, profile).alias("_event"), *[F.coalesce(c, F.lit(0)).alias(n) for n, c in cells.items()])
    per_event = per_event.groupBy("_event").agg(*[F.sum(n).alias(n) for n in cells])
    real = F.col("_event").isNotNull()
    total = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in cells]
    return per_event.agg(*total, F.count_if(real).alias("unique_events"), F.coalesce(F.sum(F.when(~real, F.col("n_rows"))), F.lit(0)).alias("missing_events"), F.count_if(real & (F.col("n_rows") > 1)).alias("multi_row_events"))


def sensor_rows(df: DataFrame, sensors: str) -> DataFrame:
    """Rows that have each sensor."""
    return df.select(F.explode(sensors).alias("sensor")).groupBy("sensor").agg(F.count("*").alias("n"))


def patterns(df: DataFrame, sensors: str) -> DataFrame:
    """How many rows have exactly each set of sensors; most frequent first, then by name."""
    name = F.array_join(F.array_sort(sensors), "+")
    return df.groupBy(F.when(F.coalesce(F.size(sensors), F.lit(0)) > 0, name).otherwise("none").alias("pattern")).agg(F.count("*").alias("n"))


def counts_by(df: DataFrame, columns: Sequence[str], cube: bool = False) -> DataFrame:
    """Counts of each group, or of every subset of the columns."""
    grouped = df.cube(*columns) if cube else df.groupBy(*columns)
    return grouped.agg(F.count("*").alias("n"), *([F.grouping_id().alias("grouping")] if cube else []))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows of each label and their share."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).drop("total")  # total: one row


def filtering(source: DataFrame, released: DataFrame, event: str, expected_source: int | None = None, expected_released: int | None = None) -> DataFrame:
    """Distinct events before and after, removed ones and unknown ones, and whether counts are as expected."""
    a, b = (x.select(null_if_sentinel(event).alias("e")).where("e is not null").distinct() for x in (source, released))
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "e", "full_outer")
    out = both.agg(F.count("a").alias("source_events"), F.count("b").alias("released_events"), F.count_if(F.col("b").isNull()).alias("removed_events"), F.count_if(F.col("a").isNull()).alias("unknown_events"))
    ok = lambda n, c: F.lit(True) if n is None else F.col(c) == n
    return out.withColumn("counts_as_expected", ok(expected_source, "source_events") & ok(expected_released, "released_events"))


def coverage_sets(df: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """How many keys have each flag, all of them, exactly two."""
    per_key = df.groupBy(key).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    n = functools.reduce(lambda x, y: x + y, [F.col(f).cast("int") for f in flags])
    return per_key.agg(*[F.count_if(F.col(f)).alias(f"has_{f}") for f in flags], F.count_if(n == len(flags)).alias("has_all"), F.count_if(n == 2).alias("has_two"))


def pair_totals(df: DataFrame, key: str, kinds: Mapping[str, Column]) -> DataFrame:
    """The sum over keys of the product of the kinds' counts."""
    per_key = df.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])
    return per_key.agg(F.coalesce(F.sum(functools.reduce(lambda x, y: x * y, [F.col(n) for n in kinds])), F.lit(0)).alias("total"))


def metrics_long(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One (manifest, metric, value) table from one-row metric tables."""
    tables = []
    for name, df in parts.items():
        cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns]
        tables.append(df.select(F.lit(name).alias("manifest"), F.inline(F.array(*cells))))
    return functools.reduce(DataFrame.unionByName, tables)


def as_json(metrics: DataFrame) -> DataFrame:
    """Each manifest's metrics as one JSON document."""
    return metrics.groupBy("manifest").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))).alias("document"))


def as_markdown(metrics: DataFrame, issues: DataFrame) -> DataFrame:
    """(place, line) of a report; order by place to print it."""
    head = metrics.sparkSession.createDataFrame([(0, "# Manifest report"), (1, "")], "place long, line string")
    rows = metrics.select(F.lit(2).cast("long").alias("place"), F.concat(F.lit("- "), F.col("manifest"), F.lit(" "), F.col("metric"), F.lit(": "), F.col("value").cast("string")).alias("line"))
    found = issues.select(F.lit(3).cast("long").alias("place"), F.concat(F.lit("- **"), F.col("severity"), F.lit("** "), F.col("code"), F.lit(": "), F.coalesce("detail", F.lit(""))).alias("line"))
    none = issues.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(3).cast("long").alias("place"), F.lit("No manifest-level validation issues were found.").alias("line"))
    return head.unionByName(rows).unionByName(found).unionByName(none)
