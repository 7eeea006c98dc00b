"""Acquisition planning: the event x sensor x timepoint grid, actions, work selection, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from eventloom.functions.clean import SENSORS, text_bool

# Timepoints in order; days that the year timepoint goes back; most cloud (percent), if it counts.
TIMEPOINTS = ("t0", "prev1", "prev2", "prev3", "seasonal", "year")
YEAR_OFFSET_DAYS = {"S2": 360, "L89": 360, "EMIT": 180, "S5P": 360}
MOST_CLOUD = {"S2": 20.0, "L89": 20.0, "EMIT": None, "S5P": None}


def slot_table(spark: SparkSession) -> DataFrame:
    """The 24 slots: sensor, timepoint, place in order, year offset, cloud limit."""
    rows = [(s, t, i, YEAR_OFFSET_DAYS[s], MOST_CLOUD[s]) for s in SENSORS for i, t in enumerate(TIMEPOINTS)]
    return spark.createDataFrame(rows, "sensor string, timepoint string, slot int, year_offset_days int, most_cloud double")


def planning_grid(events: DataFrame, has_t0: dict[str, str]) -> DataFrame:
    """Every event with each of the 24 slots (a constant table), and whether its sensor has a t0.

    has_t0: sensor -> boolean or text column of the events."""
    flags = F.create_map(*[x for s, c in has_t0.items() for x in (F.lit(s), text_bool(c))])
    return events.crossJoin(F.broadcast(slot_table(events.sparkSession))).withColumn("sensor_has_t0", F.coalesce(F.try_element_at(flags, F.col("sensor")), F.lit(False)))


def planned_action(has_t0: Column, existing_512: Column, existing_raw: Column, sensor: Column) -> Column:
    """What a slot needs; for EMIT a raw file alone doesn't do."""
    return F.when(~has_t0, "skip_no_sensor_t0").when(existing_512.isNotNull(), "skip_existing_512").when((sensor != "EMIT") & existing_raw.isNotNull(), "skip_existing_raw").otherwise("download")


def work_rows(manifest: DataFrame, sensor: str, actions: Sequence[str], timepoints: Sequence[str] | None = None) -> DataFrame:
    """rows of a sensor with the actions and timepoints; unknown names raise at once."""
    wanted = tuple(timepoints or TIMEPOINTS)
    if sensor not in SENSORS or (bad := [t for t in wanted if t not in TIMEPOINTS]):
        raise ValueError(f"unknown sensor or timepoint: {sensor}, {bad if sensor in SENSORS else ''}")
    return manifest.where((F.col("sensor") == sensor) & F.col("action").isin(*actions) & F.col("timepoint").isin(*wanted))


def rows_to_fetch(manifest: DataFrame, event: str, missing: Column) -> DataFrame:
    """Missing rows, and the t0 row of each of their events and sensors."""
    lack = manifest.where(missing)
    t0 = manifest.where("timepoint = 't0'").join(lack.select(event, "sensor").distinct(), [event, "sensor"], "left_semi")
    return lack.unionByName(t0).dropDuplicates([event, "sensor", "timepoint"])


def t0_gate(rows: DataFrame, event: str, ok: Column) -> DataFrame:
    """Q12: other timepoints go on only where their event and sensor's t0 succeeded."""
    won = F.max(F.when(F.col("timepoint") == "t0", ok.cast("int")).otherwise(0)).over(Window.partitionBy(event, "sensor"))
    return rows.withColumn("gate", F.when(F.col("timepoint") == "t0", F.when(ok, "t0_ok").otherwise("t0_failed")).when(won == 1, "proceed").otherwise("skip_t0_failed"))


def month_windows(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Months from start to end, the first and last cut to them."""
    months = F.sequence(F.trunc(start, "MM"), F.col(end).cast("date"), F.expr("interval 1 month"))
    return spans.withColumn("_m", F.explode(months)).select(*spans.columns, F.greatest("_m", F.col(start).cast("date")).alias("window_start"), F.least(F.last_day("_m"), F.col(end).cast("date")).alias("window_end"))


def offset_targets(events: DataFrame, time: str, offsets: dict[str, int]) -> DataFrame:
    """A row for each named offset with its target time."""
    cells = F.array(*[F.struct(F.lit(n).alias("timepoint"), (F.col(time).cast("timestamp") - F.make_dt_interval(days=F.lit(d))).alias("target_time")) for n, d in offsets.items()])
    return events.select(*events.columns, F.inline(cells))
