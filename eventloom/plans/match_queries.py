"""Queries of the matching, nearest, joining and ranking operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions import geo
from eventloom.operators import master, match, nearest, windows
from eventloom.plans.registry import chips, errors, points, products, query, sites, table

N = match.Names(keys=("user_id",))
DAY = 86_400_000_000


@query("""WITH ROLES SELECT event_id, product_id, epoch_us(acq_time) - epoch_us(ts) AS dt_us FROM er JOIN pr USING (user_id)
WHERE epoch_us(acq_time) BETWEEN epoch_us(ts) - 43200000000 AND epoch_us(ts) + 43200000000""")
def window_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products within 12 hours of an event."""
    return match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 0.5, 0.5).select("event_id", "product_id", "dt_us")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, sensor, epoch_us(acq_time) - epoch_us(ts) AS dt_us, row_number() OVER (PARTITION BY event_id ORDER BY epoch_us(acq_time) - epoch_us(ts), coalesce(cloud, 999), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE epoch_us(acq_time) BETWEEN epoch_us(ts) AND epoch_us(ts) + 86400000000) SELECT event_id, product_id, sensor, dt_us FROM x WHERE r = 1""")
def t0_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest product in the day after the event, then the least cloudy."""
    return match.closest(match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 0, 1), N, "cloud").select("event_id", "product_id", "sensor", "dt_us")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - epoch_us(ts)), coalesce(cloud, 999), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE CAST(acq_time AS DATE) = CAST(ts AS DATE)) SELECT event_id, product_id FROM x WHERE r = 1""")
def utc_day_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest product of the event's UTC day."""
    return match.closest(match.in_utc_day(errors(spark, sf_dir), products(spark, sf_dir), N), N, "cloud").select("event_id", "product_id")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, epoch_us(acq_time) - (epoch_us(ts) - 5 * 86400000000) AS dt_us, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - (epoch_us(ts) - 5 * 86400000000)), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE epoch_us(acq_time) - (epoch_us(ts) - 5 * 86400000000) BETWEEN -129600000000 AND 43200000000) SELECT event_id, product_id, dt_us FROM x WHERE r = 1""")
def offset_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five days back, in a window of 1.5 days before and 0.5 after."""
    return match.closest(match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 1.5, 0.5, anchor_days=5), N).select("event_id", "product_id", "dt_us")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY (CASE WHEN CAST(acq_time AS DATE) = CAST(ts AS DATE) THEN 0 ELSE 1 END), abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 172800000000) SELECT event_id, product_id FROM x WHERE r = 1""")
def same_day_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13."""
    return match.closest_same_day(match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 2, 2), N).select("event_id", "product_id")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, cloud, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(cloud, 999), abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 172800000000 AND cloud <= 60) SELECT event_id, product_id, cloud FROM x WHERE r = 1""")
def clearest_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least cloudy usable product within two days."""
    pairs = match.in_window(errors(spark, sf_dir), products(spark, sf_dir).where(match.usable("cloud", 60.0, False)), N, 2, 2)
    return match.least_cloud(pairs, N, "cloud").select("event_id", "product_id", "cloud")


@query("""WITH ROLES, x AS (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY acq_time DESC, product_id) AS r FROM er JOIN pr USING (user_id) WHERE acq_time < ts)
SELECT er.event_id, x.product_id FROM er LEFT JOIN (SELECT * FROM x WHERE r = 1) x ON er.event_id = x.event_id""")
def latest_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join."""
    return match.latest_before(errors(spark, sf_dir), products(spark, sf_dir), N).select("event_id", "product_id")


@query("""WITH ROLES, t0 AS (SELECT event_id, user_id, product_id AS t0_product, acq_time AS t0_time, overpass AS t0_overpass FROM (SELECT er.event_id, er.user_id, product_id, acq_time, overpass, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE epoch_us(acq_time) BETWEEN epoch_us(ts) AND epoch_us(ts) + 86400000000) WHERE r = 1),
c AS (SELECT event_id, overpass, product_id, acq_time FROM t0 JOIN pr USING (user_id) WHERE epoch_us(acq_time) >= epoch_us(t0_time) - 5 * 86400000000 AND acq_time < t0_time AND product_id <> t0_product AND overpass <> t0_overpass),
g AS (SELECT event_id, overpass, max(acq_time) AS newest, arg_min(product_id, -epoch_us(acq_time)) AS product_id FROM c GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY newest DESC, overpass) AS nth FROM g) SELECT event_id, overpass, product_id, nth FROM n WHERE nth = 2""")
def second_previous_overpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second distinct overpass before t0."""
    events, pr = errors(spark, sf_dir), products(spark, sf_dir)
    t0 = match.closest(match.in_window(events, pr, N, 0, 1), N).select("event_id", "user_id", F.col("product_id").alias("t0_product"), F.col("acq_time").alias("t0_time"), F.col("overpass").alias("t0_overpass"))
    out = match.nth_previous_overpass(t0, pr, N, "overpass", 2, 5.0, "t0_time", "t0_product", "t0_overpass")
    return out.select("event_id", "overpass", "product_id", F.col("nth").cast("long").alias("nth"))


@query("""WITH ROLES, t0 AS (SELECT event_id, user_id, product_id AS t0_product, acq_time AS t0_time, overpass AS t0_overpass FROM (SELECT er.event_id, er.user_id, product_id, acq_time, overpass, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r
FROM er JOIN pr USING (user_id) WHERE epoch_us(acq_time) BETWEEN epoch_us(ts) AND epoch_us(ts) + 86400000000) WHERE r = 1),
c AS (SELECT event_id, overpass, product_id, acq_time, cloud FROM t0 JOIN pr USING (user_id) WHERE epoch_us(acq_time) >= epoch_us(t0_time) - 120 * 86400000000 AND acq_time < t0_time AND product_id <> t0_product AND overpass <> t0_overpass),
g AS (SELECT event_id, overpass, max(acq_time) AS newest FROM c GROUP BY 1, 2), n AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY newest DESC, overpass) AS nth FROM g),
p AS (SELECT event_id, overpass, product_id, cloud, row_number() OVER (PARTITION BY event_id ORDER BY coalesce(cloud, 999), acq_time DESC, product_id) AS r FROM c JOIN n USING (event_id, overpass) WHERE nth = 5) SELECT event_id, overpass, product_id, cloud FROM p WHERE r = 1""")
def fifth_previous_overpass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifth distinct overpass of 120 days before t0, its least cloudy product."""
    events, pr = errors(spark, sf_dir), products(spark, sf_dir)
    t0 = match.closest(match.in_window(events, pr, N, 0, 1), N).select("event_id", "user_id", F.col("product_id").alias("t0_product"), F.col("acq_time").alias("t0_time"), F.col("overpass").alias("t0_overpass"))
    out = match.nth_previous_overpass(t0, pr, N, "overpass", 5, 120.0, "t0_time", "t0_product", "t0_overpass", "cloud", "cloud")
    return out.select("event_id", "overpass", "product_id", "cloud")


@query("""WITH ROLES, p AS (SELECT *, product_id % 360 - 180.0 AS w, product_id % 150 - 80.0 AS s FROM pr), e AS (SELECT *, ((event_id * 7919) % 18000) / 100.0 - 90 AS lat, ((event_id * 104729) % 36000) / 100.0 - 180 AS lon FROM er)
SELECT event_id, product_id FROM e JOIN p USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 86400000000 AND lat BETWEEN s - 2 AND s + 62
AND CASE WHEN w + 90 < 180 THEN (lon BETWEEN w - 2 AND w + 92 OR lon + 360 BETWEEN w - 2 AND w + 92 OR lon - 360 BETWEEN w - 2 AND w + 92) ELSE (lon >= w - 2 OR lon <= w - 270 + 2) END""")
def time_and_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a day, and in the product's padded box, over the antimeridian too."""
    place = [(((F.col("event_id") * 7919) % 18000) / 100.0 - 90).alias("lat"), (((F.col("event_id") * 104729) % 36000) / 100.0 - 180).alias("lon")]
    w, s = F.col("product_id") % 360 - 180.0, F.col("product_id") % 150 - 80.0
    boxed = products(spark, sf_dir).withColumn("b", geo.box(w, s, geo.lon180(w + 90), s + 60))
    return match.in_window_and_box(errors(spark, sf_dir).select("*", *place), boxed, N, 1, 1, "lat", "lon", F.col("b"), 2.0).select("event_id", "product_id")


@query("""WITH ROLES, e AS (SELECT *, ((event_id * 7919) % 18000) / 100.0 - 90 AS lat, ((event_id * 104729) % 36000) / 100.0 - 180 AS lon FROM er),
t AS (SELECT event_id, product_id, abs(lat - (product_id % 150 - 75.0)) AS dist_km, cloud AS qa FROM e JOIN pr USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 43200000000),
b AS (SELECT * FROM t WHERE dist_km <= 40), x AS (SELECT * FROM b WHERE product_id % 5 <> 0), best AS (SELECT event_id, product_id, dist_km, qa FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dist_km, product_id) AS r FROM x) WHERE r = 1)
SELECT er.event_id, CASE WHEN t.event_id IS NULL THEN 'no_time_candidate' WHEN b.event_id IS NULL THEN 'no_bbox_candidate' WHEN best.event_id IS NULL THEN 'pixel_match_failed' WHEN best.dist_km > 25 THEN 'too_far' WHEN coalesce(best.qa, 0) < 20 THEN 'low_qa' END AS reason, best.product_id
FROM er LEFT JOIN (SELECT DISTINCT event_id FROM t) t ON er.event_id = t.event_id LEFT JOIN (SELECT DISTINCT event_id FROM b) b ON er.event_id = b.event_id LEFT JOIN best ON er.event_id = best.event_id""")
def match_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, with its match or why there is none."""
    events = errors(spark, sf_dir).withColumn("lat", ((F.col("event_id") * 7919) % 18000) / 100.0 - 90)
    timed = match.in_window(events, products(spark, sf_dir), N, 0.5, 0.5).select("event_id", "product_id", F.abs(F.col("lat") - (F.col("product_id") % 150 - 75.0)).alias("dist_km"), F.col("cloud").alias("qa"))
    boxed = timed.where("dist_km <= 40")
    return match.match_with_reasons(events, timed, boxed, boxed.where("product_id % 5 <> 0"), "event_id", 25.0, 20.0).select("event_id", "reason", F.col("best.product_id").alias("product_id"))


@query("""WITH ROLES, e AS (SELECT *, (event_id * 7919) % 60 AS lat, (event_id * 104729) % 60 AS lon FROM er), p AS (SELECT *, product_id % 7 * 5.0 AS x, product_id % 5 * 8.0 AS y FROM pr),
m AS (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r FROM e JOIN p USING (user_id)
WHERE CAST(acq_time AS DATE) = CAST(ts AS DATE) AND ((CASE WHEN (y > lat) <> (y > lat) THEN 1 ELSE 0 END) + (CASE WHEN (y > lat) <> (y + 30 > lat) AND lon < x + 40 THEN 1 ELSE 0 END) + (CASE WHEN (y + 30 > lat) <> (y > lat) AND lon < (x - (x + 40)) * (lat - (y + 30)) / (y - (y + 30)) + x + 40 THEN 1 ELSE 0 END)) % 2 = 1)
SELECT event_id, product_id FROM m WHERE r = 1""")
def footprint_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point in a triangle footprint, on one UTC day, nearest in time."""
    events = errors(spark, sf_dir).withColumn("lat", ((F.col("event_id") * 7919) % 60).cast("double")).withColumn("lon", ((F.col("event_id") * 104729) % 60).cast("double"))
    x, y = F.col("product_id") % 7 * 5.0, F.col("product_id") % 5 * 8.0
    corner = lambda a, b: F.struct(a.alias("lon"), b.alias("lat"))
    pr = products(spark, sf_dir).withColumn("shape", F.array(corner(x, y), corner(x + 40, y), corner(x + 40, y + 30)))
    return match.in_footprint(events, pr, N, "lat", "lon", "shape").select("event_id", "product_id")


CONCAVE = [(170.0, -30.0), (-150.0, -30.0), (-150.0, 40.0), (-170.0, -10.0), (179.0, 40.0)]
_ROUND = [(x + 360 if x < 0 else x, y) for x, y in CONCAVE]
_EDGES = " + ".join(f"(CASE WHEN ({b} > lat) <> ({d} > lat) AND x < ({c} - {a}) * (lat - ({b})) / (({d}) - ({b})) + {a} THEN 1 ELSE 0 END)" for (a, b), (c, d) in zip(_ROUND, _ROUND[1:] + _ROUND[:1], strict=True) if b != d)


@query(f"""WITH ROLES, e AS (SELECT *, ((event_id * 7919) % 18000) / 100.0 - 90 AS lat, ((event_id * 104729) % 36000) / 100.0 - 180 AS lon FROM er),
m AS (SELECT event_id, product_id, lat - product_id % 9 AS lat, CASE WHEN lon < 170 THEN lon + 360 ELSE lon END AS x, abs(epoch_us(acq_time) - epoch_us(ts)) AS d FROM e JOIN pr USING (user_id) WHERE CAST(acq_time AS DATE) = CAST(ts AS DATE))
SELECT event_id, product_id FROM (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY d, product_id) AS r FROM m WHERE ({_EDGES}) % 2 = 1) WHERE r = 1""")
def concave_footprint_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concave footprints over the antimeridian, moved north by the product's number."""
    place = [(((F.col("event_id") * 7919) % 18000) / 100.0 - 90).alias("lat"), (((F.col("event_id") * 104729) % 36000) / 100.0 - 180).alias("lon")]
    shape = F.array(*[F.struct(F.lit(x).alias("lon"), (F.col("product_id") % 9 + y).cast("double").alias("lat")) for x, y in CONCAVE])
    return match.in_footprint(errors(spark, sf_dir).select("*", *place), products(spark, sf_dir).withColumn("shape", shape), N, "lat", "lon", "shape").select("event_id", "product_id")


@query("""WITH ROLES, m AS (SELECT event_id, product_id, row_number() OVER (PARTITION BY event_id ORDER BY acq_time, product_id) AS r FROM er JOIN pr ON abs(epoch_us(acq_time) - epoch_us(ts)) <= 3600000000
WHERE event_id % 90 BETWEEN product_id % 60 AND product_id % 60 + 20 AND event_id % 180 BETWEEN product_id % 100 AND product_id % 100 + 50) SELECT event_id, product_id FROM m WHERE r = 1""")
def first_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first product within the hour whose box covers the point; no common key, only time."""
    events = errors(spark, sf_dir).select("event_id", "ts", (F.col("event_id") % 90).cast("double").alias("lat"), (F.col("event_id") % 180).cast("double").alias("lon"))
    s, w = F.col("product_id") % 60, F.col("product_id") % 100
    pr = products(spark, sf_dir).select("product_id", "acq_time")
    return match.first_covering(events.where("lon < 180"), pr, match.Names(), "lat", "lon", geo.box(w, s, w + 50, s + 20), 1.0).select("event_id", "product_id")


@query("""WITH ROLES, a AS (SELECT event_id, product_id AS product_a, abs(epoch_us(acq_time) - epoch_us(ts)) AS d FROM er JOIN pr USING (user_id) WHERE sensor = 'S2' AND abs(epoch_us(acq_time) - epoch_us(ts)) <= 43200000000),
b AS (SELECT event_id, product_id AS product_b, abs(epoch_us(acq_time) - epoch_us(ts)) AS d FROM er JOIN pr USING (user_id) WHERE sensor = 'L89' AND abs(epoch_us(acq_time) - epoch_us(ts)) <= 43200000000)
SELECT event_id, product_a, product_b, round(greatest(a.d, b.d) / 3600000000.0, 6) AS max_hours FROM a JOIN b USING (event_id)""")
def two_sensor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J23."""
    pr = products(spark, sf_dir)
    out = match.two_sensor_pairs(errors(spark, sf_dir), pr.where("sensor = 'S2'"), pr.where("sensor = 'L89'"), N, 12.0)
    return out.select("event_id", "product_a", "product_b", F.round("max_hours", 6).alias("max_hours"))


@query("""WITH ROLES SELECT event_id FROM er WHERE EXISTS (SELECT 1 FROM pr WHERE pr.user_id = er.user_id AND abs(epoch_us(acq_time) - epoch_us(ts)) <= 43200000000)
AND EXISTS (SELECT 1 FROM pr WHERE pr.user_id = er.user_id AND abs(epoch_us(acq_time) - (epoch_us(ts) - 3 * 86400000000)) <= 43200000000)
AND EXISTS (SELECT 1 FROM pr WHERE pr.user_id = er.user_id AND abs(epoch_us(acq_time) - (epoch_us(ts) - 6 * 86400000000)) <= 43200000000)""")
def all_windows_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: events with a product around each of three offsets."""
    return match.every_window_filled(errors(spark, sf_dir), products(spark, sf_dir), N, [0, 3, 6], 0.5).select("event_id")


@query("""WITH ROLES, d AS (SELECT user_id, CAST(acq_time AS DATE) AS day, count(*) AS n FROM pr GROUP BY 1, 2), s AS (SELECT user_id, n, unnest(generate_series(day - INTERVAL 4 DAY, CAST(day AS TIMESTAMP), INTERVAL 1 DAY)) AS w FROM d)
SELECT user_id, strftime(min(w), '%Y-%m-%d') AS window_start FROM (SELECT user_id, w FROM s GROUP BY 1, 2 HAVING sum(n) >= 12) GROUP BY 1""")
def first_rich_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five days with 12 products or more."""
    return match.first_rich_window(products(spark, sf_dir), ["user_id"], "acq_time", 5, 12).select("user_id", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"))


@query("""WITH ROLES, p AS (SELECT event_id, product_id, epoch_us(acq_time) - epoch_us(ts) AS dt, CAST(acq_time AS DATE) = CAST(ts AS DATE) AS same FROM er JOIN pr USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 172800000000),
r AS (SELECT *, max(same::INT) OVER (PARTITION BY event_id) AS a, row_number() OVER (PARTITION BY event_id, CASE WHEN same THEN 'day' WHEN dt < 0 THEN 'before' ELSE 'after' END ORDER BY abs(dt), product_id) AS k, row_number() OVER (PARTITION BY event_id ORDER BY abs(dt), product_id) AS n FROM p)
SELECT event_id, product_id, CASE WHEN same THEN 'day' WHEN dt < 0 THEN 'before' ELSE 'after' END AS slot FROM r WHERE (a = 1 AND k = 1) OR (a = 0 AND n <= 3)""")
def slots_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W05."""
    return match.around_slots(match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 2, 2), N).select("event_id", "product_id", "slot")


@query("""WITH ROLES, p AS (SELECT event_id, product_id, sensor, row_number() OVER (PARTITION BY event_id ORDER BY abs(epoch_us(acq_time) - epoch_us(ts)), product_id) AS r FROM er JOIN pr USING (user_id) WHERE abs(epoch_us(acq_time) - epoch_us(ts)) <= 172800000000)
SELECT event_id, max(CASE WHEN r = 1 THEN product_id END) AS p1_product_id, max(CASE WHEN r = 1 THEN sensor END) AS p1_sensor, max(CASE WHEN r = 2 THEN product_id END) AS p2_product_id, max(CASE WHEN r = 2 THEN sensor END) AS p2_sensor FROM p WHERE r <= 2 GROUP BY 1""")
def ranked_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W06, R05."""
    return match.wide_ranks(match.in_window(errors(spark, sf_dir), products(spark, sf_dir), N, 2, 2), N, ["product_id", "sensor"], 2)


@query("""WITH w AS (SELECT o_orderkey, o_orderdate, epoch_us(o_orderdate) AS t, min(CASE WHEN l_linenumber = 1 THEN l_shipdate END) AS s1, min(CASE WHEN l_linenumber = 2 THEN l_shipdate END) AS s2 FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
x AS (SELECT o_orderkey, 's1' AS slot, epoch_us(s1) - t AS dt_us FROM w UNION ALL SELECT o_orderkey, 's2', epoch_us(s2) - t FROM w) SELECT o_orderkey, slot, dt_us FROM x WHERE dt_us BETWEEN -365 * 86400000000 AND 365 * 86400000000""")
def slot_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide slot times to rows inside a window."""
    li = table(spark, sf_dir, "lineitem")
    wide = table(spark, sf_dir, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey", "o_orderdate").agg(*[F.min(F.when(F.col("l_linenumber") == i, F.col("l_shipdate"))).alias(f"s{i}") for i in (1, 2)])
    return match.slots_in_window(wide, "o_orderkey", "o_orderdate", ["s1", "s2"], 365, 365).select("o_orderkey", "slot", "dt_us")


@query("""WITH ROLES, k AS (SELECT user_id, max(CASE WHEN event_id % 2 = 0 THEN ts END) AS s1, min(CASE WHEN event_id % 2 = 1 THEN ts END) AS s2 FROM events GROUP BY 1)
SELECT product_id FROM pr WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.user_id = pr.user_id AND (k.s1 = pr.acq_time OR k.s2 = pr.acq_time))""")
def unknown_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose time is in no slot of their user."""
    known = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_id") % 2 == 0, F.col("ts"))).alias("s1"), F.min(F.when(F.col("event_id") % 2 == 1, F.col("ts"))).alias("s2"))
    return match.without_known_times(products(spark, sf_dir), known, "user_id", "acq_time", ["s1", "s2"]).select("product_id")


HAVERSINE = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(olat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(olat)) * pow(sin(radians(olon - lon) / 2), 2))))"


@query(f"""WITH ROLES, d AS (SELECT pid, oid, {HAVERSINE} AS km FROM cu, su), r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY km, oid) AS r FROM d WHERE km <= 800) SELECT pid, oid, round(km, 4) AS dist_km FROM r WHERE r = 1""")
def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each point's nearest site within 800 km."""
    out = nearest.nearest_within(points(spark, sf_dir), sites(spark, sf_dir), "pid", "oid", 800.0)
    return out.select("pid", "oid", F.round("dist_km", 4).alias("dist_km"))


@query(f"""WITH ROLES, d AS (SELECT pid, oid, {HAVERSINE} AS km FROM cu, su), r AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY km, oid) AS r FROM d) SELECT pid, oid, round(km, 4) AS dist_km FROM r WHERE r = 1""")
def nearest_anywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each point's nearest site, however far."""
    return nearest.nearest(points(spark, sf_dir), sites(spark, sf_dir), "pid", "oid").select("pid", "oid", F.round("dist_km", 4).alias("dist_km"))


@query(f"""WITH ROLES, px AS (SELECT oid, olat, olon, qa, oid % 7 AS file FROM su), ev AS (SELECT pid, lat, lon, pid % 8 AS file FROM cu), d AS (SELECT pid, oid, qa, {HAVERSINE} AS km FROM ev JOIN px USING (file)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY km, oid) AS r FROM d) WHERE r = 1)
SELECT ev.pid, b.oid, round(b.km, 4) AS dist_km, CASE WHEN ev.file = 7 THEN 'no_time_candidate' WHEN abs(ev.lat) > 80 THEN 'no_bbox_candidate' WHEN b.pid IS NULL THEN 'pixel_match_failed' WHEN b.km > 3000 THEN 'too_far' WHEN coalesce(b.qa, 0) < 0 THEN 'low_qa' END AS reason FROM ev LEFT JOIN b USING (pid)""")
def swath_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest pixel of the event's swath, from however far, so that `too_far` is told with its distance."""
    events = points(spark, sf_dir).select("pid", "lat", "lon", (F.col("pid") % 8).alias("file"))
    pixels = nearest.nearest(events, sites(spark, sf_dir).withColumn("file", F.col("oid") % 7), "pid", "oid", on=["file"])
    timed = events.where("file < 7")
    out = match.match_with_reasons(events, timed, timed.where("abs(lat) <= 80"), pixels.select("pid", "dist_km", "oid", "qa"), "pid", 3000.0, 0.0)
    return out.select("pid", F.col("best.oid").alias("oid"), F.round("best.dist_km", 4).alias("dist_km"), "reason")


@query(f"""WITH ROLES, d AS (SELECT DISTINCT pid FROM cu, su WHERE {HAVERSINE} <= 300) SELECT cu.pid, d.pid IS NULL AS is_outlier FROM cu LEFT JOIN d ON cu.pid = d.pid""")
def point_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points without a site within 300 km."""
    return nearest.split_outliers(points(spark, sf_dir), sites(spark, sf_dir), "pid", 300.0, "oid").select("pid", "is_outlier")


@query(f"""WITH ROLES, d AS (SELECT pid, qa, row_number() OVER (PARTITION BY pid ORDER BY {HAVERSINE}, oid) AS r FROM cu, su WHERE {HAVERSINE} <= 500) SELECT cu.pid, coalesce(d.qa, 0.0) AS qa FROM cu LEFT JOIN (SELECT * FROM d WHERE r = 1) d ON cu.pid = d.pid""")
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest value within the bound, else 0."""
    return nearest.resample(points(spark, sf_dir), sites(spark, sf_dir), "pid", "qa", "oid", 500.0).select("pid", "qa")


@query("""WITH ROLES, g AS (SELECT floor((olat + 90) / 30) * 30 - 75 AS glat, floor((olon + 180) / 60) * 60 - 150 AS glon, avg(qa) AS v FROM su GROUP BY 1, 2),
a AS (SELECT pid, (SELECT arg_min(glat, abs(glat - lat) * 1000000 + glat) FROM (SELECT DISTINCT glat FROM g)) AS glat, (SELECT arg_min(glon, abs(glon - lon) * 1000000 + glon) FROM (SELECT DISTINCT glon FROM g)) AS glon FROM cu)
SELECT pid, round(v, 6) AS v FROM a LEFT JOIN g USING (glat, glon)""")
def grid_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest value on each grid axis, then the grid's row."""
    grid = sites(spark, sf_dir).groupBy((F.floor((F.col("olat") + 90) / 30) * 30 - 75).cast("double").alias("glat"), (F.floor((F.col("olon") + 180) / 60) * 60 - 150).cast("double").alias("glon")).agg(F.avg("qa").alias("v"))
    return nearest.grid_lookup(points(spark, sf_dir), grid, {"lat": "glat", "lon": "glon"}).select("pid", F.round("v", 6).alias("v"))


@query("""WITH ROLES, a AS (SELECT DISTINCT epoch_us(acq_time) // 3600000000 AS h FROM pr), e AS (SELECT event_id, epoch_us(ts) / 3600000000.0 AS t FROM er),
n AS (SELECT event_id, t, (SELECT max(h) FROM a WHERE h <= t) AS lo, (SELECT min(h) FROM a WHERE h >= t) AS hi FROM e) SELECT event_id, CAST(CASE WHEN hi IS NULL OR t - lo <= hi - t THEN lo ELSE hi END AS BIGINT) AS hour FROM n""")
def hourly_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's nearest hour of those with a product, an axis that grows with time."""
    hour = lambda c: F.unix_micros(c) / 3_600_000_000
    grid = products(spark, sf_dir).select(F.floor(hour("acq_time")).cast("double").alias("hour")).distinct()
    out = nearest.grid_lookup(errors(spark, sf_dir).select("event_id", hour("ts").alias("t")), grid, {"t": "hour"})
    return out.select("event_id", F.col("hour").cast("long").alias("hour"))


@query("""WITH c AS (SELECT c_custkey AS k, c_acctbal AS bal FROM customer), o AS (SELECT o_custkey AS k, o_totalprice AS bal FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1),
s AS (SELECT s_suppkey AS k, s_acctbal AS bal FROM supplier), e AS (SELECT user_id AS k, value AS bal FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1)
SELECT coalesce(c.k, o.k, s.k, e.k) AS k, coalesce(c.bal, o.bal, s.bal, e.bal) AS bal, c.k IS NOT NULL AS in_c, e.k IS NOT NULL AS in_e FROM c FULL JOIN o ON c.k = o.k FULL JOIN s ON coalesce(c.k, o.k) = s.k FULL JOIN e ON coalesce(c.k, o.k, s.k) = e.k""")
def four_way_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables, one row a key, shared columns by priority."""
    t = lambda n: table(spark, sf_dir, n)
    sides = {
        "c": t("customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.lit(1).alias("seq")), "o": t("orders").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("bal"), F.col("o_orderkey").alias("seq")),
        "s": t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"), F.lit(1).alias("seq")), "e": t("events").select(F.col("user_id").alias("k"), F.col("value").alias("bal"), F.col("event_id").alias("seq")),
    }
    merged = master.outer_merge(sides, "k", {n: ["seq"] for n in sides})
    flags = [F.col("c_seq").isNotNull().alias("in_c"), F.col("e_seq").isNotNull().alias("in_e")]
    return master.unify(merged.select("*", *flags), ["bal"], ["c", "o", "s", "e"]).select("k", "bal", "in_c", "in_e")


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1) o ON c_custkey = o_custkey""")
def lookup_best_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J03, J06, W02."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return master.lookup(table(spark, sf_dir, "customer"), orders, "c_custkey", [F.desc("o_totalprice"), "o_orderkey"]).select("c_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT e.event_id, p.product_id FROM (SELECT event_id, user_id, value FROM events WHERE event_type = 'error') e JOIN (SELECT * FROM (SELECT event_id AS product_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS r FROM events WHERE event_type <> 'error') WHERE r = 1) p USING (user_id)""")
def inner_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J04."""
    return master.inner_best(errors(spark, sf_dir), products(spark, sf_dir), "user_id", ["cloud", "product_id"]).select("event_id", "product_id")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders), b AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS p, max(o_orderkey) AS top FROM orders GROUP BY 1, 2)
SELECT o_orderkey, top FROM a LEFT JOIN b ON a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AND a.p IS NOT DISTINCT FROM b.p""")
def natural_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join on several columns where null equals null."""
    a = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("p"))
    return master.join_natural(a, a.groupBy("o_orderstatus", "p").agg(F.max("o_orderkey").alias("top")), ["o_orderstatus", "p"]).select("o_orderkey", "top")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def new_and_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti and semi joins."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return master.new_known(table(spark, sf_dir, "customer").select("c_custkey"), keys.where("o_orderstatus = 'F'"), keys.where("o_orderstatus = 'O'"), "c_custkey")


@query("""SELECT s_suppkey, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49) AS in_large, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_discount > 0.09 AND l_tax > 0.07) AS in_cheap FROM supplier""")
def membership_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set membership as columns."""
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    return master.with_membership(table(spark, sf_dir, "supplier").select("s_suppkey"), {"in_large": li.where("l_quantity > 49"), "in_cheap": li.where("l_discount > 0.09 and l_tax > 0.07")}, "s_suppkey")


@query("""WITH u AS (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) SELECT c_custkey, coalesce(o_orderstatus, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN u ON c_custkey = o_custkey AND r = 1""")
def overlay_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last previous result wins where it has a value."""
    prev = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("c_mktsegment"))
    return master.overlay(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), prev, "c_custkey", "seq", ["c_mktsegment"])


@query("""WITH f AS (SELECT DISTINCT 'p' || l_partkey AS path FROM lineitem WHERE l_quantity > 45), c AS (SELECT p_partkey, 'p' || p_partkey AS a, 'p' || (p_partkey + 1) AS b, 'p' || (p_partkey * 2) AS d FROM part)
SELECT p_partkey, coalesce((SELECT path FROM f WHERE path = a), (SELECT path FROM f WHERE path = b), (SELECT path FROM f WHERE path = d)) AS mask, CASE WHEN a IN (SELECT path FROM f) THEN 'a' WHEN b IN (SELECT path FROM f) THEN 'b' WHEN d IN (SELECT path FROM f) THEN 'd' END AS mask_from FROM c""")
def first_existing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three paths the first that exists."""
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    files = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(name(F.col("l_partkey")).alias("path"), F.lit(1).alias("length"))
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", name(k).alias("a"), name(k + 1).alias("b"), name(k * 2).alias("d"))
    return master.first_existing(rows, files, "p_partkey", ["a", "b", "d"], "mask").select("p_partkey", "mask", "mask_from")


@query("""SELECT l_orderkey, arg_min(l_linenumber, l_suppkey * 1000 + l_linenumber) AS l_linenumber FROM lineitem WHERE l_quantity >= 30 GROUP BY 1""")
def first_valid_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid row of least priority."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    return master.first_valid_place(li, ["l_orderkey"], "l_suppkey", F.col("l_quantity") >= 30, "l_linenumber").select("l_orderkey", "l_linenumber")


@query("""SELECT user_id, event_id, CAST(r AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r <= 3""")
def ranked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of each key in an explicit order."""
    ev = windows.rank_rows(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), "event_id"])
    return windows.first_n_per_key(ev, ["user_id"], ["rank"], 3).select("user_id", "event_id", F.col("rank").cast("long").alias("rank"))


@query("""SELECT o_custkey, arg_max(o_orderkey, o_totalprice) AS o_orderkey FROM orders GROUP BY 1""")
def farthest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of greatest measure."""
    return windows.farthest(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_totalprice"), "o_orderkey").select("o_custkey", "o_orderkey")


@query("""WITH s AS (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS t FROM orders GROUP BY 1) SELECT o_custkey, n, CAST(coalesce(sum(n) OVER (ORDER BY epoch_us(t), o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM s""")
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A global running sum by ranges."""
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.unix_micros(F.max("o_orderdate")).alias("t"))
    return windows.running_total(s, "n", "t", ["o_custkey"], "before").select("o_custkey", "n", "before")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return windows.top_k(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("""WITH v AS (SELECT DISTINCT o_orderstatus, o_custkey FROM orders WHERE o_totalprice > 400000), r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey) AS r FROM v)
SELECT o_orderstatus, count(*) AS n_values, string_agg(CASE WHEN r <= 20 THEN CAST(o_custkey AS VARCHAR) END, ',' ORDER BY o_custkey) AS examples FROM r GROUP BY 1""")
def capped_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, with up to 20 example values."""
    out = windows.examples(table(spark, sf_dir, "orders").where("o_totalprice > 400000"), "o_custkey", ["o_orderstatus"], 20)
    return out.select("o_orderstatus", "n_values", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"))


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_custkey, o_orderstatus, min(o_orderkey) AS k FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2)
SELECT o_custkey, o_orderstatus, count(*) AS n FROM (SELECT o_custkey, o_orderstatus FROM a UNION ALL SELECT o_custkey, o_orderstatus FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus)) GROUP BY 1, 2""")
def append_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append rows whose signature is new."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = windows.append_new(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_custkey", "o_orderstatus"])
    return out.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT 'c' AS sensor, c_custkey AS id, c_acctbal AS amount FROM customer UNION ALL SELECT 's', s_suppkey, s_acctbal FROM supplier""")
def harmonised_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of other column names, one below the other."""
    t = lambda n: table(spark, sf_dir, n)
    return windows.union_named({"c": (t("customer").select("c_custkey", "c_acctbal"), {"c_custkey": "id", "c_acctbal": "amount"}), "s": (t("supplier").select("s_suppkey", "s_acctbal"), {"s_suppkey": "id", "s_acctbal": "amount"})}).select("sensor", "id", "amount")


@query("""SELECT a.vec_id AS chip_id, b.vec_id AS other_id FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.label = b.label""")
def label_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J04 on chips: successive chips of one label."""
    a = chips(spark, sf_dir).select("chip_id", "label")
    b = a.select((F.col("chip_id") - 1).alias("chip_id"), F.col("chip_id").alias("other_id"), F.col("label").alias("other"))
    return a.join(b, "chip_id").where("label = other").select("chip_id", "other_id")
