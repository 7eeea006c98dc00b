"""Train/test splits that don't leak, samples that any engine reproduces, leak audits."""

from __future__ import annotations

import datetime
import functools
import operator
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventloom.functions.clean import hash_fraction
from eventloom.operators.cover import computed
from eventloom.operators.windows import first_n_per_key, rank_rows, running_total
from eventloom.scratch import Scratch

# The last date of train and the first of test for each sensor, and the dates of the split without gap.
GAP_RULES = {"S2": ("2025-05-16", "2025-05-18"), "L89": ("2025-05-10", "2025-05-11"), "EMIT": ("2025-02-11", "2025-02-12"), "S5P": ("2025-07-16", "2025-07-21")}
CUTOFFS = {"S2": "2025-07-27", "L89": "2025-07-30", "EMIT": "2025-03-08", "S5P": "2025-10-19"}


def _dates(table: Mapping[str, str]) -> Column:
    return F.create_map(*[x for s, d in table.items() for x in (F.lit(s), F.lit(datetime.date.fromisoformat(d)))])


def temporal_split(df: DataFrame, date: str, sensors: str, mode: str, cutoffs: Mapping[str, str] = CUTOFFS, rules: Mapping[str, tuple[str, str]] = GAP_RULES) -> DataFrame:
    """Adds `split` (train, test, gap) and `gap_reason` from the date and the sensors present.

    cutoff_no_gap: any sensor past its cutoff makes test.  strict: all sensors on one side.
    loose_test_priority: any sensor in test, else any in train.
    """
    day, have = F.col(date), F.col(sensors)
    if mode == "cutoff_no_gap":
        split = F.when(F.exists(have, lambda s: day > F.try_element_at(_dates(cutoffs), s)), "test").otherwise("train")
    elif mode in ("strict", "loose_test_priority"):
        last, first = _dates({s: r[0] for s, r in rules.items()}), _dates({s: r[1] for s, r in rules.items()})
        in_train, in_test = (lambda s: day <= F.try_element_at(last, s)), (lambda s: day >= F.try_element_at(first, s))
        some = F.exists if mode == "loose_test_priority" else F.forall
        test, train = F.when(some(have, in_test), "test"), F.when(some(have, in_train), "train")
        split = F.coalesce(test, train, F.lit("gap"))
    else:
        raise ValueError(f"mode: {mode}")
    none, bad = F.coalesce(F.size(have), F.lit(0)) <= 0, day.isNull()
    out = df.withColumn("split", F.when(none | bad, "gap").otherwise(split))
    return out.withColumn("gap_reason", F.when(none, "no_sensor").when(bad, "bad_datetime").when(F.col("split") == "gap", "mixed_or_window"))


def split_summary(df: DataFrame, sensors: str) -> DataFrame:
    """Rows of each sensor in each split, and the shares."""
    rows = df.select(F.explode(sensors).alias("sensor"), "split")
    counts = rows.groupBy("sensor").agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "test", "gap")])
    usable = F.col("train") + F.col("test")
    return counts.withColumn("test_share", F.try_divide(F.col("test"), usable)).withColumn("usable_share", F.try_divide(usable, usable + F.col("gap")))


def hash_split(df: DataFrame, key: Column | str, ratio: float, fallback: Column | str | None = None) -> DataFrame:
    """Train where the key's hash fraction is under the ratio; rows without key use the fallback."""
    k = F.col(key) if isinstance(key, str) else key
    if fallback is not None:
        k = F.coalesce(k.cast("string"), (F.col(fallback) if isinstance(fallback, str) else fallback).cast("string"))
    return df.withColumn("split", F.when(hash_fraction(k) < ratio, "train").otherwise("test"))


def date_band_split(df: DataFrame, time: str, start: str, end: str, test_inside: bool = True) -> DataFrame:
    """Test inside of [start, end], or outside of it."""
    inside = F.col(time).cast("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return df.withColumn("split", F.when(inside if test_inside else ~inside, "test").otherwise("train"))


def _salted(key: str, seed: int) -> Column:
    """What rows are hashed by: any engine can do it."""
    return F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))


def chronological_split(df: DataFrame, time: str, tie: str, ratio: float) -> DataFrame:
    """The first floor(ratio * n) rows by (time, tie) train, one row on either side at least.

    A row's place is a running count over ranges of time, so no task sorts all rows.
    """
    us = F.unix_micros(F.col(time).cast("timestamp"))
    placed = running_total(df.withColumn("_t", us).withColumn("_one", F.lit(1)), "_one", "_t", [tie], "_place")
    n = df.count()
    cut = min(max(int(n * ratio), 1), max(n - 1, 1))
    return placed.withColumn("split", F.when(F.col("_place") < cut, "train").otherwise("test")).drop("_t", "_one", "_place")


def site_split(df: DataFrame, site: str, time: str, ratio: float, seed: int | None = None) -> DataFrame:
    """Whole sites to train until they hold ratio of all rows: by their last time, or (seed) in an
    order by hash.  A site is in while the rows of the sites before it are under the cut; of two sites
    or more the last is always test."""
    order = F.unix_micros(F.max(F.col(time).cast("timestamp"))) if seed is None else hash_fraction(_salted(site, seed))
    sites = df.groupBy(site).agg(F.count("*").alias("_n"), order.alias("_order"))
    placed = running_total(sites, "_n", "_order", [site], "_before")
    n, k = df.count(), sites.count()
    total = placed.withColumn("_last", (F.col("_before") + F.col("_n") == n) & F.lit(k > 1))
    split = F.when((F.col("_before") < ratio * n) & ~F.col("_last"), "train").otherwise("test")
    return df.join(total.select(F.col(site).alias("_site"), split.alias("split")), F.col(site).eqNullSafe(F.col("_site"))).drop("_site")


def spherical_clusters(df: DataFrame, lat: str, lon: str, key: str, clusters: int = 20, seed: int = 0, rounds: int = 25) -> DataFrame:
    """Adds `cluster`: k-means of the places on the unit sphere, so that poles and antimeridian are places like others.

    The first centre is the place of least hash of `key` and seed; each other one is the place farthest from those
    before it, of a sample of 50 places a cluster by the same hash.  Then centres and assignments take turns
    until none moves, `rounds` times at most.  Centres are few, and are rounded to 9 digits, so neither
    partitioning nor order of rows changes the result.  Rows without a place have cluster null.
    """
    x, y, z = F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))
    placed = computed(df, _x=x, _y=y, _z=z)
    order = F.xxhash64(F.col(key).cast("string"), F.lit(seed))
    sample = [(r["_x"], r["_y"], r["_z"]) for r in placed.where("_x + _y + _z is not null and not isnan(_x + _y + _z)").select("_x", "_y", "_z", order.alias("_o"), key).orderBy("_o", key).limit(50 * clusters).collect()]
    apart = lambda a, b: round(sum((p - q) ** 2 for p, q in zip(a, b, strict=True)), 12)
    centres = sample[:1]
    while sample and len(centres) < clusters:
        gap, i = max((min(apart(s, c) for c in centres), -i) for i, s in enumerate(sample))
        if not gap:
            break
        centres.append(sample[-i])

    def nearest(of: list[tuple[float, float, float]]) -> Column:
        cells = [F.struct(F.round(functools.reduce(operator.add, [F.pow(F.col(a) - v, 2) for a, v in zip(("_x", "_y", "_z"), c, strict=True)]), 12).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(of)]
        return F.when((F.col("_x") + F.col("_y") + F.col("_z")).isNotNull(), F.array_min(F.array(*cells))["i"]) if of else F.lit(None).cast("int")

    for _ in range(rounds):
        if not centres:
            break
        means = placed.select("_x", "_y", "_z", nearest(centres).alias("c")).where("c is not null").groupBy("c").agg(*[F.avg(a).alias(a) for a in ("_x", "_y", "_z")]).collect()
        moved = list(centres)
        for r in means:
            size = (r["_x"] ** 2 + r["_y"] ** 2 + r["_z"] ** 2) ** 0.5 or 1.0
            moved[r["c"]] = tuple(round(r[a] / size, 9) for a in ("_x", "_y", "_z"))
        if moved == centres:
            break
        centres = moved
    return placed.withColumn("cluster", nearest(centres)).drop("_x", "_y", "_z")


def cluster_split(df: DataFrame, lat: str, lon: str, key: str, clusters: int = 20, test_share: float = 0.4, seed: int = 0, of_rows: bool = False) -> DataFrame:
    """Clusters of places, whole ones to test: the share of the clusters, in an order by hash; or (of_rows) clusters in
    that order while the rows before them are under the share of all, so that test has the share of rows but for a part
    of one cluster.  Rows without a place are train."""
    found = spherical_clusters(df, lat, lon, key, clusters, seed)
    sizes = {r["cluster"]: r["count"] for r in found.where("cluster is not null").groupBy("cluster").count().collect()}  # as many as clusters
    order, before = sorted(sizes, key=lambda c: ((c * 2654435761 + seed * 40503) % 2**32, c)), 0
    test = order[: round(len(order) * test_share)]
    if of_rows:
        test = []
        for c in order:
            if before < test_share * sum(sizes.values()):
                test.append(c)
            before += sizes[c]
    return found.withColumn("split", F.when(F.col("cluster").isin(test), "test").otherwise("train"))


def lists_split(df: DataFrame, key: str, train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test by given key lists, train first; others unassigned."""
    flag = lambda x, n: x.select(key).distinct().withColumn(n, F.lit(True))
    joined = df.join(flag(train, "_train"), key, "left").join(flag(test, "_test"), key, "left")
    return joined.withColumn("split", F.when(F.col("_train"), "train").when(F.col("_test"), "test").otherwise("unassigned")).drop("_train", "_test")


def balanced(df: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """As many rows of either label, the larger class thinned by hash; raises if a class is empty.

    The threshold is found on hash buckets first, so a class is never ranked in one task.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect() if r[label] is not None}
    if len(counts) < 2:
        raise ValueError("a class is empty")
    n = min(counts.values())
    parts = None
    for value, have in counts.items():
        rows = df.where(F.col(label) == value)
        if have > n:
            rows = hash_sample(rows, key, n, seed)
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """The n rows of least hash of key and seed, ties by key.

    A running count over ranges of the hash places rows; no task ranks all of them.
    """
    placed = running_total(df.withColumn("_h", hash_fraction(_salted(key, seed))).withColumn("_one", F.lit(1)), "_one", "_h", [key], "_place")
    return placed.where(F.col("_place") < n).drop("_h", "_one", "_place")


def md5_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of least MD5 fraction, as other engines compute it."""
    return df.orderBy(hash_fraction(key), key).limit(n)


def half_per_class(df: DataFrame, label: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """N rows, half of either class."""
    return hash_sample(df.where(F.col(label) == 1), key, n // 2, seed).unionByName(hash_sample(df.where(F.col(label) == 0), key, n - n // 2, seed))


def balanced_per_event(df: DataFrame, event: str, label: str, order: Sequence[Column | str]) -> DataFrame:
    """All positives of each event and as many negatives in the order; events without positives go."""
    ranked = rank_rows(df, [event, label], order, "_rank")
    positives = df.where(F.col(label) == 1).groupBy(event).agg(F.count("*").alias("_n"))
    return ranked.join(positives, event).where((F.col(label) == 1) | (F.col("_rank") <= F.col("_n"))).drop("_rank", "_n")


def leaks(df: DataFrame, key: str, split: str = "split", by: Sequence[str] = ()) -> DataFrame:
    """Keys that stand in both train and test (of each `by`)."""
    sides = df.where(F.col(split).isin("train", "test")).groupBy(*by, key).agg(F.count_distinct(split).alias("n"))
    return sides.where("n = 2").drop("n")


def draws(events: DataFrame, event: str, n: int, low: int, high: int, seed: str = "", labels: Sequence[int] = (1,), start: int = 1) -> DataFrame:
    """N draws (dx, dy) in [low, high) for each event and label, numbered from `start`; a hash of event, label and
    number decides them, so any engine and any partitioning gives the same."""
    rows = events.withColumn("label", F.explode(F.array(*[F.lit(x) for x in labels])))
    return _drawn(rows, event, n, low, high, seed, start)


def _drawn(rows: DataFrame, event: str, n: int, low: int, high: int, seed: str, start: int) -> DataFrame:
    rows = rows.withColumn("draw", F.explode(F.sequence(F.lit(start), F.lit(start + n - 1))))
    def value(axis: str) -> Column:
        key = F.concat_ws(":", F.col(event).cast("string"), F.col("label").cast("string"), F.col("draw").cast("string"), F.lit(axis + seed))
        return (F.lit(low) + F.floor(hash_fraction(key) * (high - low))).cast("int")
    return rows.withColumn("dx", value("x")).withColumn("dy", value("y"))


def quota_draws(events: DataFrame, event: str, quota: Mapping[int, int], attempts: Mapping[int, int], accept: Callable[[DataFrame], DataFrame], low: int, high: int, seed: str = "", scratch: Scratch | None = None) -> DataFrame:
    """For each event and label the first `quota` draws that `accept` lets pass, of `attempts` at most; those of
    events that don't get so many, too.

    accept: (event's columns, label, draw, dx, dy) -> the accepted ones, with what columns it likes.  Draws come in
    rounds: as many as are asked for, then twice as many, and so on, only for events and labels still short.  Since a
    draw is decided by its number, rounds only save work: the rows are those of all attempts at once.
    """
    scratch = scratch or Scratch(events.sparkSession)
    events = scratch.written(events)
    parts = []
    for label, wanted in quota.items():
        short, start, n = events.withColumn("label", F.lit(label)), 1, max(1, wanted)
        while start <= attempts[label]:
            n = min(n, attempts[label] - start + 1)
            got = scratch.written(accept(_drawn(short, event, n, low, high, seed, start)))
            parts.append(got)
            start, n = start + n, 2 * n
            if start > attempts[label]:
                break
            have = functools.reduce(DataFrame.unionByName, [p.where(F.col("label") == label).select(event, "label") for p in parts])
            full = have.groupBy(event).agg(F.count("*").alias("_n")).where(F.col("_n") >= wanted)
            short = scratch.written(events.join(full.select(event), event, "left_anti").withColumn("label", F.lit(label)))
            if short.isEmpty():
                break
    rows = functools.reduce(DataFrame.unionByName, parts)
    limit = F.create_map(*[F.lit(x) for kv in quota.items() for x in kv])[F.col("label")]
    return first_n_per_key(rows, [event, "label"], ["draw"], limit)


def first_valid_draws(rows: DataFrame, event: str, n: int, valid: Column) -> DataFrame:
    """The first n valid draws of each event and label."""
    return first_n_per_key(rows, [event, "label"], ["draw"], n, valid)
