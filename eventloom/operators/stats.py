"""Statistics and evaluation metrics over rows, groups and scores."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from eventloom.functions import geo
from eventloom.scratch import Scratch


#: Values of a group that one task may hold; bins of a counting pass.
HELD, BINS = 1_000_000, 1024


def percentiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (), held: int = HELD, scratch: Scratch | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, as columns p50, p99 ...; nulls don't count.

    Where no group has more than `held` values, one aggregation finds them.  Otherwise the ranks asked for are closed
    in by counting: each pass counts the values between a rank's bounds in BINS bins and goes on with the bin that
    holds it, until `held` values or one repeated value are left; only those are sorted.  So no group's values
    meet in one task, and what is shuffled are bins.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= held:
        found = df.groupBy(*by).agg(F.percentile(F.col(value).cast("double"), [float(s) for s in shares]).alias("_p"))
        return found.select(*by, *[F.col("_p")[i].alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])
    ranks = _closed_in(rows, sizes, shares, list(by), held, scratch or Scratch(df.sparkSession))
    between = F.col("_at") - F.floor("_at")
    one = ranks.groupBy(*by, "_i", "_at").agg(F.min("_x").alias("_x"), F.max("_x").alias("_y")).withColumn("_p", F.col("_x") + (F.col("_y") - F.col("_x")) * between)
    return one.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, F.col("_p"))).alias(f"p{round(100 * s)}") for i, s in enumerate(shares)])


def _closed_in(rows: DataFrame, sizes: DataFrame, shares: Sequence[float], by: list[str], held: int, scratch: Scratch) -> DataFrame:
    """(by, _i, _at, _rank, _x): the values at the ranks next to each share's place `_at`."""
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), (F.lit(float(s)) * (F.col("_n") - 1)).alias("_at")) for i, s in enumerate(shares)]))
    asked = sizes.withColumn("_s", places).select(*by, "_n", "_lo", "_hi", "_s.*")
    asked = asked.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at"))))).withColumn("_below", F.lit(0).cast("long"))
    bounds = scratch.written(asked.select(*by, "_i", "_at", "_rank", "_below", F.col("_n").alias("_in"), "_lo", "_hi"))
    own = [*by, "_i", "_at", "_rank"]

    def inside(part: DataFrame) -> DataFrame:
        near = rows.join(part, by) if by else rows.crossJoin(F.broadcast(part))  # two rows a share
        return near.where(F.col("_v").between(F.col("_lo"), F.col("_hi")))

    closed = []
    while True:
        done = (F.col("_in") <= held) | (F.col("_lo") >= F.col("_hi"))
        closed.append(bounds.where(done))
        wide = bounds.where(~done)
        if wide.isEmpty():
            break
        # Halves first, so that no difference overflows.
        bin_of = F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * BINS), F.lit(BINS - 1))
        bins = inside(wide).groupBy(*own, "_below", bin_of.alias("_bin")).agg(F.count("*").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.coalesce(F.sum("_in").over(Window.partitionBy(*own).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumn("_below", F.col("_below") + before).where((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_in")))
        bounds = scratch.written(bins.select(*own, "_below", "_in", "_lo", "_hi"))
    last = functools.reduce(DataFrame.unionByName, closed)
    same = last.where("_lo >= _hi").select(*own, F.col("_lo").alias("_x"))
    few = inside(last.where("_lo < _hi")).groupBy(*own, "_below").agg(F.array_sort(F.collect_list("_v")).alias("_all"))
    return same.unionByName(few.select(*own, F.get("_all", (F.col("_rank") - F.col("_below")).cast("int")).alias("_x")))


def exceedance(df: DataFrame, value: str, thresholds: Sequence[float]) -> DataFrame:
    """How many values exceed each threshold, in one pass."""
    counts = df.agg(*[F.count_if(F.col(value) > t).alias(f"_{i}") for i, t in enumerate(thresholds)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_{i}").alias("n")) for i, t in enumerate(thresholds)])))


def top_categories(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values of each column, ties by value."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))).where(F.col("rank") <= k)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation and range of each number column."""
    cells = []
    for c in columns:
        cells += [F.count(c).alias(f"{c}|n"), F.avg(c).alias(f"{c}|mean"), F.stddev(c).alias(f"{c}|std"), F.min(c).alias(f"{c}|min"), F.max(c).alias(f"{c}|max")]
    one = df.agg(*cells)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").cast("double").alias(s) for s in ("n", "mean", "std", "min", "max")]) for c in columns])))


def yearly(df: DataFrame, time: str, lat: str, lon: str) -> DataFrame:
    """Rows and centroid of each year."""
    return df.groupBy(F.year(F.col(time).cast("timestamp")).alias("year")).agg(F.count("*").alias("n"), F.avg(lat).alias("mean_lat"), F.avg(lon).alias("mean_lon"))


def centroid_shift(df: DataFrame, first: Column, second: Column, lat: str, lon: str) -> DataFrame:
    """Kilometres between the centroids of two sets of rows."""
    mean = lambda c, of: F.avg(F.when(of, F.col(c)))
    one = df.agg(mean(lat, first).alias("lat1"), mean(lon, first).alias("lon1"), mean(lat, second).alias("lat2"), mean(lon, second).alias("lon2"))
    return one.withColumn("shift_km", geo.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")))


def channel_stats(df: DataFrame, channel: Sequence[str], value: str) -> DataFrame:
    """Mean and population deviation of each channel's values (NaN counts as missing)."""
    v = F.when(~F.isnan(value), F.col(value))
    return df.groupBy(*channel).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count(v).alias("n"))


def noisy_or(df: DataFrame, key: Sequence[str], q: str) -> DataFrame:
    """1 - prod(1 - q); a q of 1 gives 1.  A sum of logarithms where none is 1, so groups may be large."""
    sure = F.max(F.when(F.col(q) >= 1, 1).otherwise(0))
    return df.groupBy(*key).agg(F.when(sure == 1, 1.0).otherwise(1 - F.exp(F.sum(F.when(F.col(q) < 1, F.log1p(-F.col(q)))))).alias("combined"))


def robust_scale(df: DataFrame, value: str, name: str, held: int = HELD) -> DataFrame:
    """(x - median) / (p95 - median), cut to [0, 1]; see `percentiles` for `held`."""
    p = percentiles(df, value, [0.5, 0.95], held=held).select(F.array("p50", "p95").alias("_p"))
    scaled = F.try_divide(F.col(value) - F.col("_p")[0], F.col("_p")[1] - F.col("_p")[0])
    return df.crossJoin(F.broadcast(p)).withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(scaled, F.lit(0.0))))).drop("_p")  # p: one row


def dominance(a: Column, b: Column, tolerance: float) -> Column:
    """Which of two scores dominates."""
    return F.when(F.abs(a - b) <= tolerance, "balanced").when(a > b, "first").otherwise("second")


def usability(df: DataFrame, keys: Sequence[str], time_term: Column, clear_term: Column, spatial: Column, contrast: str) -> DataFrame:
    """The best product of the three terms and the best contrast of each key."""
    return df.groupBy(*keys).agg(F.max(time_term * spatial * clear_term).alias("best_q"), F.max(contrast).alias("best_contrast"))


def anomaly(df: DataFrame, key: Sequence[str], now: Column, value: str) -> DataFrame:
    """The value now less the median of the others (NaN is missing)."""
    v = F.when(~F.isnan(value), F.col(value))
    return df.groupBy(*key).agg((F.max(F.when(now, v)) - F.median(F.when(~now, v))).alias("anomaly"), F.count(F.when(~now, v)).alias("n_history"))


def confusion(df: DataFrame, predicted: Column, actual: Column, by: Sequence[str] = ()) -> DataFrame:
    """Counts, accuracy, precision, recall, F1 (0 where undefined)."""
    counts = df.groupBy(*by).agg(F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumn("accuracy", share(tp + tn, tp + fp + fn + tn)).withColumn("precision", share(tp, tp + fp)).withColumn("recall", share(tp, tp + fn)).withColumn("f1", share(2 * tp, 2 * tp + fp + fn))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve; tied scores share their mean rank.

    Counts per distinct score, then running sums over ranges of scores, so no task sorts all rows.
    """
    from eventloom.operators.windows import running_total

    per = df.groupBy(F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    placed = running_total(per, "n", "score", [], "below")
    total = placed.agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"), F.sum(F.col("p") * (F.col("below") + F.col("n") / 2)).alias("u"))
    return total.select("n_pos", "n_neg", F.try_divide(F.col("u"), F.col("n_pos") * F.col("n_neg")).alias("auc"))


def regression(df: DataFrame, predicted: Column, actual: Column, tolerance: float) -> DataFrame:
    """MSE, R2, explained variance, share within the tolerance, MAPE."""
    e = predicted - actual
    one = df.agg(F.avg(e * e).alias("mse"), F.var_pop(actual).alias("_var"), F.var_pop(e).alias("_evar"), F.avg((F.abs(e) <= tolerance).cast("double")).alias("within"), F.avg(F.try_divide(F.abs(e), F.abs(actual))).alias("mape"))
    return one.select("mse", (1 - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"), (1 - F.try_divide(F.col("_evar"), F.col("_var"))).alias("explained_variance"), "within", "mape")


def size_distribution(df: DataFrame, height: str, width: str) -> DataFrame:
    """How many of each size, with its area."""
    return df.groupBy(height, width).agg(F.count("*").alias("n")).withColumn("area", F.col(height).cast("long") * F.col(width))


def pivot_means(df: DataFrame, key: Sequence[str], variable: str, level: str, levels: Sequence[tuple[str, int]], value: str) -> DataFrame:
    """Means by variable and level as columns."""
    return df.groupBy(*key).agg(*[F.avg(F.when((F.col(variable) == v) & (F.col(level) == p), F.col(value))).alias(f"{v}_{p}") for v, p in levels])


def footprint(df: DataFrame, key: Sequence[str], lat: str, lon: str) -> DataFrame:
    """Bounds of each key's pixels, longitude in both forms."""
    good = lambda c: F.when(~F.isnan(c), F.col(c).cast("double"))
    wide = F.pmod(good(lon), F.lit(360.0))
    return df.groupBy(*key).agg(F.min(good(lat)).alias("lat_min"), F.max(good(lat)).alias("lat_max"), F.min(good(lon)).alias("lon_min"), F.max(good(lon)).alias("lon_max"), F.min(wide).alias("lon360_min"), F.max(wide).alias("lon360_max"))


def complete_groups(df: DataFrame, key: Sequence[str], least: int) -> DataFrame:
    """Keys with `least` rows or more."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values of each column, exact or by sketch."""
    count = (lambda c: F.approx_count_distinct(c, 0.02)) if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])
