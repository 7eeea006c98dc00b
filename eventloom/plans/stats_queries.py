"""Queries of the statistics, chip and streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions import clean, geo, names, temporal
from eventloom.operators import chips as C, stats
from eventloom.plans.registry import chips, points, query, table

#: Chip pixels as rows: chip_id, label, i (0 to 63), v.
PIXELS = "px AS (SELECT vec_id AS chip_id, label, i - 1 AS i, CAST(embedding[i] AS DOUBLE) AS v FROM (SELECT *, unnest(generate_series(1, 64)) AS i FROM embeddings))"


@query("""SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS p100 FROM events GROUP BY 1""")
def value_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10."""
    out = stats.percentiles(table(spark, sf_dir, "events"), "value", [0.5, 0.75, 0.9, 0.99, 1.0], ["event_type"])
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("p50", "p75", "p90", "p99")], "p100")


@query("""SELECT t AS threshold, (SELECT count(*) FROM events WHERE value > t) AS n FROM (SELECT unnest([10.0::DOUBLE, 50.0, 100.0]) AS t)""")
def exceedances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11."""
    return stats.exceedance(table(spark, sf_dir, "events"), "value", [10, 50, 100])


@query("""WITH l AS (SELECT 'lang' AS "column", lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents), c AS (SELECT "column", value, count(*) AS n FROM l GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INT) AS rank FROM c) SELECT * FROM r WHERE rank <= 10""")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12."""
    return stats.top_categories(table(spark, sf_dir, "documents"), ["lang", "source"], 10)


@query("""SELECT 'l_quantity' AS "column", count(l_quantity)::DOUBLE AS n, round(avg(l_quantity), 6) AS mean, round(stddev(l_quantity), 6) AS std, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem UNION ALL SELECT 'l_tax', count(l_tax), round(avg(l_tax), 6), round(stddev(l_tax), 6), min(l_tax), max(l_tax) FROM lineitem""")
def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12."""
    return stats.describe(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax"]).select("column", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query("""SELECT CAST(date_part('year', o_orderdate) AS INT) AS year, count(*) AS n, round(avg(o_totalprice), 4) AS mean_lat, round(avg(o_custkey), 4) AS mean_lon FROM orders GROUP BY 1""")
def yearly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G13."""
    return stats.yearly(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "o_custkey").select("year", "n", F.round("mean_lat", 4).alias("mean_lat"), F.round("mean_lon", 4).alias("mean_lon"))


@query("""WITH ROLES, m AS (SELECT avg(lat) FILTER (nation < 12) AS a, avg(lon) FILTER (nation < 12) AS b, avg(lat) FILTER (nation >= 12) AS c, avg(lon) FILTER (nation >= 12) AS d FROM cu)
SELECT round(2 * 6371.0 * asin(sqrt(pow(sin((radians(c) - radians(a)) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2))), 3) AS shift_km FROM m""")
def centroid_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G14."""
    return stats.centroid_shift(points(spark, sf_dir), F.col("nation") < 12, F.col("nation") >= 12, "lat", "lon").select(F.round("shift_km", 3).alias("shift_km"))


@query("WITH " + PIXELS + " SELECT CAST(i AS INT) AS channel, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, count(*) AS n FROM px GROUP BY 1")
def channel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G15."""
    long = chips(spark, sf_dir).select(F.posexplode("px").alias("channel", "v"))
    return stats.channel_stats(long, ["channel"], "v").select("channel", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


@query("WITH " + PIXELS + " SELECT chip_id, round(min(v), 6) AS min, round(max(v), 6) AS max, round(avg(v), 6) AS mean, round(stddev_pop(v), 5) AS std, round(count(*) FILTER (v < 0.05) / 64.0, 6) AS low FROM px GROUP BY 1")
def pixel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a chip inside its row."""
    c = chips(spark, sf_dir).withColumn("s", C.pixel_stats("px")).withColumn("low", C.share_zero(F.transform("px", lambda v: F.when(v >= 0.05, v).otherwise(0.0))))
    return c.select("chip_id", *[F.round(F.col("s")[n], 5 if n == "std" else 6).alias(n) for n in ("min", "max", "mean", "std")], F.round("low", 6).alias("low"))


@query("WITH " + PIXELS + ", m AS (SELECT chip_id, i // 8 AS y, i % 8 AS x FROM px WHERE v > 0.15) SELECT chip_id, CAST(max(y) - min(y) + 1 AS BIGINT) AS height_px, CAST(max(x) - min(x) + 1 AS BIGINT) AS width_px, CAST(count(*) AS BIGINT) AS area_px, count(*) * 100.0 AS area_m2 FROM m GROUP BY 1")
def mask_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks by threshold and their extent."""
    m = chips(spark, sf_dir).withColumn("m", F.transform("px", lambda v: (v > 0.15).cast("double"))).withColumn("e", C.mask_extent("m", 8, 10.0)).where("e is not null")
    return m.select("chip_id", F.col("e.height_px").cast("long").alias("height_px"), F.col("e.width_px").cast("long").alias("width_px"), F.col("e.area_px").cast("long").alias("area_px"), F.col("e.area_m2").alias("area_m2"))


@query("WITH " + PIXELS + """, s AS (SELECT chip_id, count(*) FILTER (i < 24) AS a, avg(v) FILTER (i < 24) AS ma, avg(v) FILTER (i >= 24) AS mb, stddev_pop(v) FILTER (i < 24) AS sa, stddev_pop(v) FILTER (i >= 24) AS sb FROM px GROUP BY 1)
SELECT chip_id, round(abs(ma - mb) / sb, 5) AS d_m, round(abs(ma - mb) / (sa + sb), 5) AS d_o FROM s""")
def separability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G19."""
    c = chips(spark, sf_dir).withColumn("mask", F.transform("px", lambda v, i: (i < 24).cast("double")))
    return C.separability(c, ["chip_id", "band"], "px", "mask").select("chip_id", F.round("d_m", 5).alias("d_m"), F.round("d_o", 5).alias("d_o"))


@query("""SELECT user_id, event_type, round(max(exp(-abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) / 86400000000.0 / 5.0) * greatest(0.0, least(1.0, 1 - (CASE WHEN value > 1 THEN value / 100 ELSE value END)))), 6) AS best_q, max(value) AS best_contrast FROM events GROUP BY 1, 2""")
def usability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G20, P36, P37."""
    days = temporal.days_between("ts", F.lit("2024-01-15T00:00:00Z").cast("timestamp"))
    out = stats.usability(table(spark, sf_dir, "events"), ["user_id", "event_type"], temporal.time_decay(days, 5.0), geo.clearness("value"), F.lit(1.0), "value")
    return out.select("user_id", "event_type", F.round("best_q", 6).alias("best_q"), "best_contrast")


@query("""SELECT l_orderkey, round(CASE WHEN max(l_discount * 10) >= 1 THEN 1.0 ELSE 1 - exp(sum(ln(1 - least(l_discount * 10, 0.999999)))) END, 5) AS combined FROM lineitem GROUP BY 1""")
def noisy_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G21."""
    q = table(spark, sf_dir, "lineitem").withColumn("q", F.col("l_discount") * 10)
    return stats.noisy_or(q, ["l_orderkey"], "q").select("l_orderkey", F.round("combined", 5).alias("combined"))


@query("""WITH p AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.95) AS h FROM events) SELECT event_id, round(greatest(0.0, least(1.0, (value - m) / (h - m))), 6) AS scaled FROM events, p""")
def robust_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G22."""
    return stats.robust_scale(table(spark, sf_dir, "events"), "value", "scaled").select("event_id", F.round("scaled", 6).alias("scaled"))


@query("""SELECT kind, count(*) AS n FROM (SELECT CASE WHEN abs(l_tax - l_discount) <= 0.015 THEN 'balanced' WHEN l_tax > l_discount THEN 'first' ELSE 'second' END AS kind FROM lineitem) GROUP BY 1""")
def dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G23."""
    return table(spark, sf_dir, "lineitem").groupBy(stats.dominance(F.col("l_tax"), F.col("l_discount"), 0.015).alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT user_id, max(ts) AS t0 FROM events GROUP BY 1) SELECT user_id, round(max(value) FILTER (ts = t0) - median(value) FILTER (ts <> t0), 6) AS anomaly, count(value) FILTER (ts <> t0) AS n_history FROM events JOIN t USING (user_id) GROUP BY 1""")
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value less the median of the earlier ones."""
    e = table(spark, sf_dir, "events")
    rows = e.join(e.groupBy("user_id").agg(F.max("ts").alias("t0")), "user_id")
    return stats.anomaly(rows, ["user_id"], F.col("ts") == F.col("t0"), "value").select("user_id", F.round("anomaly", 6).alias("anomaly"), "n_history")


@query("WITH " + PIXELS + ", d AS (SELECT chip_id, label, avg(abs(v - (SELECT 0.1))) AS m FROM px GROUP BY 1, 2) SELECT label, round(avg(m), 6) AS mean_difference, count(*) AS n FROM d GROUP BY 1")
def label_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute differences by label."""
    c = chips(spark, sf_dir).withColumn("d", C.mean_abs_difference("px", F.transform("px", lambda v: F.lit(0.1))))
    return c.groupBy("label").agg(F.round(F.avg("d"), 6).alias("mean_difference"), F.count("*").alias("n"))


@query("""WITH s AS (SELECT n_chars > 1000 AS p, quality = 1 AS a FROM labels l JOIN documents d ON l.doc_id = d.doc_id), c AS (SELECT count(*) FILTER (p AND a) AS tp, count(*) FILTER (p AND NOT a) AS fp, count(*) FILTER (NOT p AND a) AS fn, count(*) FILTER (NOT p AND NOT a) AS tn FROM s)
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1 FROM c""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G27."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    out = stats.confusion(rows, F.col("n_chars") > 1000, F.col("quality") == 1)
    return out.select("tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("""WITH s AS (SELECT n_chars AS x, quality AS y FROM labels l JOIN documents d ON l.doc_id = d.doc_id), r AS (SELECT y, avg(rn) OVER (PARTITION BY x) AS rk FROM (SELECT *, row_number() OVER (ORDER BY x) AS rn FROM s))
SELECT count(*) FILTER (y = 1) AS n_pos, count(*) FILTER (y = 0) AS n_neg, round((sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM r""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tied scores share their mean rank."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return stats.roc_auc(rows, "n_chars", "quality").select("n_pos", "n_neg", F.round("auc", 6).alias("auc"))


@query("""WITH e AS (SELECT l_quantity * 1800.0 AS p, l_extendedprice AS a FROM lineitem) SELECT round(avg((p - a) * (p - a)) / 1000000, 4) AS mse_m, round(1 - avg((p - a) * (p - a)) / var_pop(a), 6) AS r2, round(1 - var_pop(p - a) / var_pop(a), 6) AS explained_variance, round(avg(CASE WHEN abs(p - a) <= 5000 THEN 1.0 ELSE 0.0 END), 6) AS within, round(avg(abs(p - a) / nullif(abs(a), 0)), 6) AS mape FROM e""")
def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G29."""
    out = stats.regression(table(spark, sf_dir, "lineitem"), F.col("l_quantity") * 1800.0, F.col("l_extendedprice"), 5000.0)
    return out.select(F.round(F.col("mse") / 1000000, 4).alias("mse_m"), *[F.round(c, 6).alias(c) for c in ("r2", "explained_variance", "within", "mape")])


@query("""SELECT p_size AS h, p_size % 7 AS w, count(*) AS n, CAST(p_size AS BIGINT) * (p_size % 7) AS area FROM part GROUP BY 1, 2""")
def size_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G32."""
    return stats.size_distribution(table(spark, sf_dir, "part").select(F.col("p_size").alias("h"), (F.col("p_size") % 7).alias("w")), "h", "w")


@query("""SELECT l_orderkey, avg(l_tax) FILTER (l_returnflag = 'A' AND l_linenumber = 1) AS "A_1", avg(l_tax) FILTER (l_returnflag = 'R' AND l_linenumber = 2) AS "R_2" FROM lineitem GROUP BY 1""")
def pivot_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G33."""
    return stats.pivot_means(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "l_linenumber", [("A", 1), ("R", 2)], "l_tax")


@query("""WITH ROLES SELECT nation, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max, round(min(((lon % 360) + 360) % 360), 6) AS lon360_min, round(max(((lon % 360) + 360) % 360), 6) AS lon360_max FROM cu GROUP BY 1""")
def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G34."""
    return stats.footprint(points(spark, sf_dir), ["nation"], "lat", "lon").select("nation", "lat_min", "lat_max", "lon_min", "lon_max", F.round("lon360_min", 6).alias("lon360_min"), F.round("lon360_max", 6).alias("lon360_max"))


@query("""SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 6""")
def complete_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G35."""
    return stats.complete_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey"], 6)


@query("""SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type, count(DISTINCT props) AS props FROM events""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G38."""
    return stats.distinct_counts(table(spark, sf_dir, "events"), ["user_id", "event_type", "props"])


@query("WITH " + PIXELS + " SELECT chip_id, round(sum(v) FILTER (i // 8 BETWEEN 2 AND 4 AND i % 8 BETWEEN 3 AND 5), 6) AS total, count(*) FILTER (i // 8 BETWEEN 2 AND 4 AND i % 8 BETWEEN 3 AND 5) AS n FROM px GROUP BY 1")
def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 3 x 3 window of each chip."""
    c = chips(spark, sf_dir).withColumn("w", C.crop("px", "height", "width", 2, 3, 3, 3))
    return c.select("chip_id", F.round(F.aggregate("w", F.lit(0.0), lambda s, v: s + v), 6).alias("total"), F.size("w").cast("long").alias("n"))


@query("WITH " + PIXELS + ", w AS (SELECT * FROM (SELECT unnest([0, 3, 5]) AS y), (SELECT unnest([0, 3, 5]) AS x)) SELECT chip_id, y, x, round(sum(v), 6) AS total FROM px, w WHERE i // 8 BETWEEN y AND y + 2 AND i % 8 BETWEEN x AND x + 2 GROUP BY 1, 2, 3")
def window_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a grid with stride 3, the last ones at the edge."""
    w = C.window_grid(chips(spark, sf_dir), 8, 8, 3, 3)
    return w.select("chip_id", "y", "x", F.round(F.aggregate(C.crop("px", "height", "width", "y", "x", 3, 3), F.lit(0.0), lambda s, v: s + v), 6).alias("total"))


@query("WITH " + PIXELS + """, o AS (SELECT unnest(generate_series(0, 24)) AS j), g AS (SELECT j, (j // 5) * 7 / 4.0 AS fy, (j % 5) * 7 / 4.0 AS fx FROM o), k AS (SELECT j, floor(fy) AS y0, floor(fx) AS x0, least(floor(fy) + 1, 7) AS y1, least(floor(fx) + 1, 7) AS x1, fy - floor(fy) AS wy, fx - floor(fx) AS wx FROM g)
SELECT chip_id, round(sum(v * ((CASE WHEN i // 8 = y0 THEN 1 - wy ELSE 0 END) + (CASE WHEN i // 8 = y1 THEN wy ELSE 0 END)) * ((CASE WHEN i % 8 = x0 THEN 1 - wx ELSE 0 END) + (CASE WHEN i % 8 = x1 THEN wx ELSE 0 END)) * (j + 1)), 4) AS checksum FROM px, k GROUP BY 1""")
def resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 to 5 x 5, aligned corners; a weighted sum of all pixels."""
    c = chips(spark, sf_dir).withColumn("r", C.resize_linear("px", 8, 8, 5, 5))
    return c.select("chip_id", F.round(F.aggregate(F.transform("r", lambda v, i: v * (i + 1)), F.lit(0.0), lambda s, v: s + v), 4).alias("checksum"))


@query("WITH " + PIXELS + ", w AS (SELECT i, i % 4 AS band, 1.0 + i % 3 AS weight FROM (SELECT unnest(generate_series(0, 63)) AS i)) SELECT chip_id, CAST(band AS INT) AS band, round(sum(v * weight) / sum(weight), 6) AS value FROM px JOIN w USING (i) GROUP BY 1, 2")
def band_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chips as spectra of 64 bands to four target bands."""
    w = spark.range(64).select(F.col("id").cast("int").alias("band_idx"), (F.col("id") % 4).cast("int").alias("band"), (1.0 + F.col("id") % 3).alias("weight"))
    return C.convolve_bands(chips(spark, sf_dir).select("chip_id", "px"), ["chip_id"], "px", w).select("chip_id", "band", F.round("value", 6).alias("value"))


@query("WITH " + PIXELS + ", p AS (SELECT chip_id, quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.9) AS hi FROM px GROUP BY 1) SELECT chip_id, round(sum(greatest(0.0, least(1.0, (v - lo) / (hi - lo)))), 5) AS total FROM px JOIN p USING (chip_id) GROUP BY 1")
def stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X08."""
    c = C.stretch(chips(spark, sf_dir), ["chip_id", "band"], "px", 0.1, 0.9)
    return c.select("chip_id", F.round(F.aggregate("px", F.lit(0.0), lambda s, v: s + v), 5).alias("total"))


@query("WITH " + PIXELS + ", s AS (SELECT label, avg(v) AS m, stddev_pop(v) AS d FROM px GROUP BY 1) SELECT chip_id, round(sum((v - m) / d), 4) AS total FROM px JOIN s USING (label) GROUP BY 1")
def normalised_chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X09, G15."""
    c = chips(spark, sf_dir)
    st = stats.channel_stats(c.select("label", F.explode("px").alias("v")), ["label"], "v")
    return C.normalised(c, st, ["label"], "px").select("chip_id", F.round(F.aggregate("px", F.lit(0.0), lambda s, v: s + v), 4).alias("total"))


@query("WITH " + PIXELS + ", m AS (SELECT chip_id, i // 8 AS y, i % 8 AS x FROM px WHERE v > 0.15), w AS (SELECT y0, x0 FROM (SELECT unnest([0, 2, 4, 6]) AS y0), (SELECT unnest([0, 2, 4, 6]) AS x0)), c AS (SELECT DISTINCT chip_id FROM m), p AS (SELECT chip_id, y0, x0, y0 + dy AS y, x0 + dx AS x FROM c, w, (SELECT unnest([0, 1]) AS dy), (SELECT unnest([0, 1]) AS dx)), d AS (SELECT p.chip_id, y0, x0, p.y, p.x, min(sqrt(pow(p.y - m.y, 2) + pow(p.x - m.x, 2))) AS d FROM p JOIN m ON p.chip_id = m.chip_id GROUP BY ALL) SELECT chip_id, CAST(y0 AS INT) AS y, CAST(x0 AS INT) AS x, round(min(d), 5) AS min_distance, round(avg(d), 5) AS mean_distance FROM d GROUP BY 1, 2, 3")
def mask_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of windows to the mask."""
    c = chips(spark, sf_dir)
    masks = c.select("chip_id", F.transform("px", lambda v: (v > 0.15).cast("double")).alias("m"))
    w = C.window_grid(c.select("chip_id"), 8, 8, 2, 2)
    return C.distance_to_mask(w, masks, ["chip_id"], "m", 8, 2).select("chip_id", "y", "x", F.round("min_distance", 5).alias("min_distance"), F.round("mean_distance", 5).alias("mean_distance"))


@query("WITH " + PIXELS + ", w AS (SELECT * FROM (SELECT unnest([0, 2, 4, 5]) AS y), (SELECT unnest([0, 2, 4, 5]) AS x)), s AS (SELECT chip_id, y, x, round(sum(v), 6) AS score FROM px, w WHERE i // 8 BETWEEN y AND y + 2 AND i % 8 BETWEEN x AND x + 2 GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY chip_id ORDER BY score DESC, y, x) AS r FROM s) SELECT chip_id, y, x, score FROM r WHERE r <= 2")
def best_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best windows of each chip."""
    w = C.window_grid(chips(spark, sf_dir), 8, 8, 3, 2)
    score = F.round(F.aggregate(C.crop("px", "height", "width", "y", "x", 3, 3), F.lit(0.0), lambda s, v: s + v), 6)
    return C.best_windows(w, ["chip_id"], score, 2).select("chip_id", "y", "x", "score")


@query("""SELECT o_orderkey, CAST(least(greatest(o_custkey % 600 - 40, 0), 448) AS BIGINT) AS at, CAST(abs(least(greatest(o_custkey % 600 - 40, 0), 448) - (o_custkey % 600 - 40)) AS BIGINT) AS shift FROM orders""")
def clamped_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X18."""
    w = geo.clamp_window(F.col("o_custkey") % 600 - 40, 64, 512)
    return table(spark, sf_dir, "orders").select("o_orderkey", w["at"].alias("at"), w["shift"].alias("shift"))


@query("""SELECT part.p_partkey, chr(49 + CAST(p_size % 9 AS INT)) || ',' || p_size AS centers, CAST(1 + p_size % 9 AS INT) AS cy, p_size AS cx FROM part""")
def centre_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of centres read and written again."""
    p = table(spark, sf_dir, "part").withColumn("t", F.concat((1 + F.col("p_size") % 9).cast("string"), F.lit(","), F.col("p_size").cast("string"), F.lit(";x,1")))
    c = names.parse_centers("t")
    return p.select("p_partkey", names.encode_centers(c).alias("centers"), c[0]["cy"].alias("cy"), c[0]["cx"].alias("cx"))


@query("""SELECT 'lang' AS "column", count(*) FILTER (lang IS NULL) AS n_missing FROM documents UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM documents""")
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F06."""
    return clean.missing_report(table(spark, sf_dir, "documents"), ["lang", "text"])
