"""Queries of the cleaning functions, reports, splits, state, planning and quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions import clean, geo, names, temporal
from eventloom.operators import master, planning, quality, report, splits, state
from eventloom.plans.registry import day_text, errors, points, products, query, sensor_of, table
from eventloom.sources import scans, sinks

#: Events as a loosely typed manifest: null spellings, bad numbers and times appear by rule.
LOOSE_SQL = """WITH m AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN ' NaN ' WHEN event_id % 19 = 0 THEN 'None' ELSE CAST(user_id AS VARCHAR) END AS event,
CASE WHEN event_id % 23 = 0 THEN '' WHEN event_id % 29 = 0 THEN 'north' ELSE CAST(value - 20 AS VARCHAR) END AS lat, CAST(value - 200 AS VARCHAR) AS lon,
CASE WHEN event_id % 31 = 0 THEN 'bad' WHEN event_id % 37 = 0 THEN 'null' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS seen FROM events)"""


def loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i, text = F.col("event_id"), lambda c: c.cast("string")
    return e.select(
        "event_id", F.when(i % 17 == 0, " NaN ").when(i % 19 == 0, "None").otherwise(text(F.col("user_id"))).alias("event"),
        F.when(i % 23 == 0, "").when(i % 29 == 0, "north").otherwise(text(F.col("value") - 20)).alias("lat"), text(F.col("value") - 200).alias("lon"),
        F.when(i % 31 == 0, "bad").when(i % 37 == 0, "null").otherwise(temporal.iso_z("ts")).alias("seen"),
    )


@query(LOOSE_SQL + """, v AS (SELECT CASE WHEN lower(trim(event)) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim(event) END AS ev, trim(lat) = '' AS ml, try_cast(lat AS DOUBLE) AS la, try_cast(lon AS DOUBLE) AS lo, seen FROM m),
e AS (SELECT ev, count(*) AS n FROM v GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (ml) AS BIGINT) AS missing_coordinates, CAST(count(*) FILTER ((NOT ml AND (la IS NULL OR abs(la) > 90)) OR lo IS NULL OR abs(lo) > 180) AS BIGINT) AS invalid_coordinates,
CAST(count(*) FILTER (seen = 'null') AS BIGINT) AS missing_datetime, CAST(count(*) FILTER (seen = 'bad') AS BIGINT) AS invalid_datetime, (SELECT count(ev) FROM e) AS unique_events, (SELECT CAST(sum(n) AS BIGINT) FROM e WHERE ev IS NULL) AS missing_events, (SELECT count(*) FROM e WHERE ev IS NOT NULL AND n > 1) AS multi_row_events FROM v""")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship report over a loosely typed manifest."""
    return report.summary(loose(spark, sf_dir), "event", "lat", "lon", "seen")


@query(LOOSE_SQL + """SELECT event_id, CASE WHEN lower(trim(event)) IN ('', 'nan', 'none', 'null', '<na>') THEN NULL ELSE trim(event) END AS event, CASE WHEN lower(trim(event)) IN ('', 'nan', 'none') THEN '' ELSE trim(event) END AS event_text,
CASE WHEN trim(lat) = '' THEN 'missing' WHEN try_cast(lat AS DOUBLE) IS NULL THEN 'invalid' END AS lat_flaw, epoch_us(try_cast(replace(seen, 'Z', '') AS TIMESTAMP)) AS at_us, event_id % 4 = 0 OR event_id % 4 = 2 AS flag FROM m""")
def cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text, numbers, times and flags."""
    spelled = F.element_at(F.array(F.lit("YES"), F.lit("no"), F.lit(" true"), F.lit("")), (F.col("event_id") % 4 + 1).cast("int"))
    return loose(spark, sf_dir).select("event_id", clean.first_value(["event"]).alias("event"), clean.clean_text("event").alias("event_text"), clean.number_flaw("lat").alias("lat_flaw"), F.unix_micros(temporal.parse_utc("seen")).alias("at_us"), clean.text_bool(spelled).alias("flag"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch_us(date_trunc('hour', ts + INTERVAL 30 MINUTE)) AS nearest, epoch_us(date_trunc('hour', ts)) AS floor, epoch_us(CASE WHEN ts = date_trunc('hour', ts) THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END) AS ceil,
epoch_us(strptime(strftime(ts, '%Y%m%dT%H%M%S'), '%Y%m%dT%H%M%S')) AS stamp, strftime(ts, '%Y-%m-%d') AS day, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) / 86400000000.0, 6) AS days, abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15')) <= 2 * 86400000000 AS near FROM events""")
def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times read, rounded, found in names and compared."""
    e = table(spark, sf_dir, "events")
    name = F.concat(F.lit("EMIT_L2A_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_001.nc"))
    at = F.lit("2024-01-15T00:00:00Z").cast("timestamp")
    micro = lambda c: F.unix_micros(c)
    return e.select(
        "event_id", temporal.iso_z("ts").alias("iso"), micro(temporal.round_hour("ts")).alias("nearest"), micro(temporal.round_hour("ts", "floor")).alias("floor"), micro(temporal.round_hour("ts", "ceil")).alias("ceil"),
        micro(temporal.image_time([("log", F.lit(None).cast("timestamp")), ("name", temporal.stamp_in_name(name))])[0]).alias("stamp"), day_text(temporal.row_date(temporal.iso_z("ts"))).alias("day"),
        F.round(temporal.days_between("ts", at), 6).alias("days"), temporal.near_any("ts", [at], 2.0).alias("near"),
    )


@query("""WITH ROLES SELECT pid, CAST(floor((lat + 90) / 5) AS INT) AS tile_row, CAST(floor((lon + 180) / 5) AS INT) AS tile_col, round(((lon % 360) + 360) % 360, 6) AS lon360, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + floor((lon + 180) / 6) + 1 AS INT) AS epsg,
round(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians(10.0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(10.0)) * pow(sin(radians(20.0 - lon) / 2), 2)))), 3) AS km, lat BETWEEN -30 AND 40 AND (lon >= 150 OR lon <= -120) AS in_box FROM cu""")
def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longitudes, tiles, zones, distances, boxes over the antimeridian."""
    row, col = geo.tile("lat", "lon", 5.0)
    b = geo.box(F.lit(150.0), F.lit(-30.0), F.lit(-120.0), F.lit(40.0))
    km = geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(10.0), F.lit(20.0))
    return points(spark, sf_dir).select("pid", row.alias("tile_row"), col.alias("tile_col"), F.round(geo.lon360("lon"), 6).alias("lon360"), geo.utm_epsg("lat", "lon").alias("epsg"), F.round(km, 3).alias("km"), geo.in_box(F.col("lat"), F.col("lon"), b).alias("in_box"))


@query("""WITH ROLES SELECT pid, printf('%.2f_%.2f', lat, lon) AS site, round(sqrt(bal * bal + lat * lat), 4) AS speed, round(((270 - degrees(atan2(lat, bal))) % 360 + 360) % 360, 4) AS direction,
CASE WHEN nation % 5 = 0 THEN 1.0 ELSE greatest(0.0, least(1.0, 1 - (CASE WHEN nation * 5.0 > 1 THEN nation * 5.0 / 100 ELSE nation * 5.0 END))) END AS clear, CAST(greatest(1, round_even(120 / 30.0, 0)) AS INT) AS patch FROM cu WHERE lat <> 0 AND lon <> 0""")
def derived_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site keys, wind, clearness, patch sizes."""
    cloud = F.when(F.col("nation") % 5 != 0, F.col("nation") * 5.0)
    return points(spark, sf_dir).where("lat <> 0 and lon <> 0").select("pid", geo.site_id("lat", "lon", 2).alias("site"), F.round(geo.wind_speed("bal", "lat"), 4).alias("speed"), F.round(geo.wind_from("bal", "lat"), 4).alias("direction"), geo.clearness(cloud).alias("clear"), geo.patch_px(120.0, F.lit("L89")).alias("patch"))


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page, CASE WHEN url LIKE '%ref=x' THEN left(url, length(url) - 5) || 'ref=y' ELSE url END AS swapped, 'R' || '_' || CAST(page_id AS VARCHAR) AS overpass FROM pages""")
def name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of structured names, suffixes, overpass keys."""
    at = F.timestamp_seconds(F.col("page_id") * 600)
    return table(spark, sf_dir, "pages").select("page_id", names.extract("url", "^https?://([^/]+)/").alias("host"), names.extract("url", "[?&]page=([0-9]+)").alias("page"), names.swap_suffix("url", "ref=x", "ref=y").alias("swapped"), names.overpass_s2("url", at).alias("overpass"))


@query("""WITH k AS (SELECT user_id, date_trunc('day', ts) AS d, list_sort(list_distinct(list(CASE event_type WHEN 'view' THEN 'S2' WHEN 'click' THEN 'L89' WHEN 'purchase' THEN 'EMIT' WHEN 'signup' THEN 'S5P' END) FILTER (event_type <> 'error'))) AS s FROM events GROUP BY 1, 2)
SELECT CASE WHEN s IS NULL OR len(s) = 0 THEN 'none' ELSE array_to_string(s, '+') END AS pattern, count(*) AS n FROM k GROUP BY 1""")
def availability_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sensor sets and how often they occur."""
    e = table(spark, sf_dir, "events").withColumn("s", F.when(F.col("event_type") != "error", sensor_of()))
    days = e.groupBy("user_id", F.date_trunc("day", "ts").alias("d")).agg(F.concat_ws(" , ", F.collect_set(F.lower("s"))).alias("listed"))
    return report.patterns(days.withColumn("sensors", clean.sensor_list("listed")), "sensors")


@query("""SELECT event_type, date_part('hour', ts)::INT AS hour, count(*) AS n, CAST(grouping(event_type, date_part('hour', ts)::INT) AS BIGINT) AS grouping FROM events GROUP BY CUBE (event_type, date_part('hour', ts)::INT)""")
def cube_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G04, G06."""
    return report.counts_by(table(spark, sf_dir, "events").withColumn("hour", F.hour("ts")), ["event_type", "hour"], cube=True)


@query("""SELECT quality, count(*) AS n, count(*) / (SELECT count(*) FROM labels)::DOUBLE AS share FROM labels GROUP BY 1""")
def label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G05."""
    return report.label_counts(table(spark, sf_dir, "labels"), "quality")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS e FROM orders), b AS (SELECT DISTINCT o_custkey AS e FROM orders WHERE o_orderstatus = 'F')
SELECT (SELECT count(*) FROM a) AS source_events, (SELECT count(*) FROM b) AS released_events, (SELECT count(*) FROM a WHERE e NOT IN (SELECT e FROM b)) AS removed_events, (SELECT count(*) FROM b WHERE e NOT IN (SELECT e FROM a)) AS unknown_events, false AS counts_as_expected""")
def filtering_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G09."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("e"), "o_orderstatus")
    return report.filtering(o, o.where("o_orderstatus = 'F'"), "e", expected_source=-1)


@query("""WITH k AS (SELECT l_orderkey, bool_or(l_returnflag = 'A') AS a, bool_or(l_returnflag = 'N') AS n, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (a) AS has_a, count(*) FILTER (n) AS has_n, count(*) FILTER (r) AS has_r, count(*) FILTER (a AND n AND r) AS has_all, count(*) FILTER (a::INT + n::INT + r::INT = 2) AS has_two FROM k""")
def coverage_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G31."""
    return report.coverage_sets(table(spark, sf_dir, "lineitem"), "l_orderkey", {x.lower(): F.col("l_returnflag") == x for x in "ANR"})


@query("""SELECT CAST(sum(a * n * r) AS BIGINT) AS total FROM (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)""")
def pair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G39."""
    return report.pair_totals(table(spark, sf_dir, "lineitem"), "l_orderkey", {x.lower(): F.col("l_returnflag") == x for x in "ANR"})


HASH_SQL = "CAST(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967295.0"


@query(f"""SELECT o_orderkey, CASE WHEN {HASH_SQL.format('o_custkey')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L05, L10, P40."""
    return splits.hash_split(table(spark, sf_dir, "orders"), "o_custkey", 0.8, "o_orderkey").select("o_orderkey", "split")


@query(f"""WITH s AS (SELECT o_custkey, CASE WHEN {HASH_SQL.format('o_orderkey')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders) SELECT o_custkey FROM s GROUP BY 1 HAVING count(DISTINCT split) = 2""")
def leak_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that a row-wise split puts on both sides."""
    return splits.leaks(splits.hash_split(table(spark, sf_dir, "orders"), "o_orderkey", 0.8), "o_custkey")


@query("""WITH d AS (SELECT event_id, CAST(ts AS DATE) + 490 AS day, list_filter([CASE WHEN event_id % 2 = 0 THEN 'S2' END, CASE WHEN event_id % 3 = 0 THEN 'L89' END, CASE WHEN event_id % 5 = 0 THEN 'EMIT' END], lambda x: x IS NOT NULL) AS s FROM events)
SELECT event_id, CASE WHEN len(s) = 0 THEN 'gap' WHEN len(list_filter(s, lambda x: (x = 'S2' AND day >= DATE '2025-05-18') OR (x = 'L89' AND day >= DATE '2025-05-11') OR (x = 'EMIT' AND day >= DATE '2025-02-12'))) = len(s) THEN 'test'
WHEN len(list_filter(s, lambda x: (x = 'S2' AND day <= DATE '2025-05-16') OR (x = 'L89' AND day <= DATE '2025-05-10') OR (x = 'EMIT' AND day <= DATE '2025-02-11'))) = len(s) THEN 'train' ELSE 'gap' END AS split FROM d""")
def temporal_split_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates shifted into the rules' range, sensors by rule."""
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").withColumn("day", F.date_add(F.to_date("ts"), 490)).withColumn("s", F.array_compact(F.array(F.when(i % 2 == 0, "S2"), F.when(i % 3 == 0, "L89"), F.when(i % 5 == 0, "EMIT"))))
    return splits.temporal_split(e, "day", "s", "strict").select("event_id", "split")


@query("""WITH d AS (SELECT event_id, CAST(ts AS DATE) + 560 AS day, list_filter([CASE WHEN event_id % 2 = 0 THEN 'S2' END, CASE WHEN event_id % 3 = 0 THEN 'L89' END], lambda x: x IS NOT NULL) AS s FROM events),
r AS (SELECT s, CASE WHEN len(s) = 0 THEN 'gap' WHEN len(list_filter(s, lambda x: (x = 'S2' AND day > DATE '2025-07-27') OR (x = 'L89' AND day > DATE '2025-07-30'))) > 0 THEN 'test' ELSE 'train' END AS split FROM d), x AS (SELECT unnest(s) AS sensor, split FROM r)
SELECT sensor, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test, count(*) FILTER (split = 'gap') AS gap, round(count(*) FILTER (split = 'test') / count(*) FILTER (split <> 'gap')::DOUBLE, 6) AS test_share FROM x GROUP BY 1""")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L01, G07."""
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").withColumn("day", F.date_add(F.to_date("ts"), 560)).withColumn("s", F.array_compact(F.array(F.when(i % 2 == 0, "S2"), F.when(i % 3 == 0, "L89"))))
    return splits.split_summary(splits.temporal_split(e, "day", "s", "cutoff_no_gap"), "s").select("sensor", "train", "test", "gap", F.round("test_share", 6).alias("test_share"))


@query("""SELECT event_id, CASE WHEN ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' THEN 'test' ELSE 'train' END AS split FROM events""")
def date_band_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L06, F04."""
    return splits.date_band_split(table(spark, sf_dir, "events"), "ts", "2024-01-10T00:00:00Z", "2024-01-20T00:00:00Z").select("event_id", "split")


@query("""SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor((SELECT count(*) FROM events) * 0.7) THEN 'train' ELSE 'test' END AS split FROM events""")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W07."""
    return splits.chronological_split(table(spark, sf_dir, "events"), "ts", "event_id", 0.7).select("event_id", "split")


@query("""WITH s AS (SELECT user_id, count(*) AS n, max(ts) AS t FROM events GROUP BY 1), b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY t, user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
SELECT event_id, CASE WHEN before < 0.6 * (SELECT count(*) FROM events) AND before + n < (SELECT count(*) FROM events) THEN 'train' ELSE 'test' END AS split FROM events JOIN b USING (user_id)""")
def site_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sites by their last time."""
    return splits.site_split(table(spark, sf_dir, "events"), "user_id", "ts", 0.6).select("event_id", "split")


@query("""SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') THEN 'train' WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) THEN 'test' ELSE 'unassigned' END AS split FROM orders""")
def listed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L11."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return splits.lists_split(table(spark, sf_dir, "orders"), "o_custkey", c.where("c_mktsegment = 'MACHINERY'"), c.where("c_nationkey < 5")).select("o_orderkey", "split")


@query(f"""SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {HASH_SQL.format("doc_id || ':0'")}, doc_id) AS r FROM labels WHERE quality IS NOT NULL) WHERE r <= least((SELECT count(*) FROM labels WHERE quality = 0), (SELECT count(*) FROM labels WHERE quality = 1))""")
def balanced_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many of either class, those of least hash."""
    return splits.balanced(table(spark, sf_dir, "labels").where("quality is not null"), "quality", "doc_id").select("doc_id", "quality")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS pos, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_linenumber, l_partkey) AS k, count(*) FILTER (l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS np FROM lineitem)
SELECT l_orderkey, count(*) FILTER (pos) AS positives, count(*) FILTER (NOT pos) AS negatives FROM r WHERE np > 0 AND (pos OR k <= np) GROUP BY 1""")
def balanced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L13."""
    li = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    out = splits.balanced_per_event(li, "l_orderkey", "label", ["l_linenumber", "l_partkey"])
    return out.groupBy("l_orderkey").agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))


@query(f"""SELECT doc_id FROM labels ORDER BY {HASH_SQL.format('doc_id')}, doc_id LIMIT 100""")
def sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 100 that any engine draws alike."""
    return splits.md5_sample(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", 100)


def clustered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means on coordinates."""
    return splits.cluster_split(points(spark, sf_dir), "lat", "lon", "pid", 10).select("pid", "cluster", "split")


query()(clustered_split)


@query("""WITH o AS (SELECT DISTINCT o_orderkey, o_orderstatus = 'F' AS good FROM orders) SELECT event_id, sensor, timepoint, CASE WHEN NOT CASE sensor WHEN 'S2' THEN event_id % 2 = 0 WHEN 'L89' THEN event_id % 3 = 0 WHEN 'EMIT' THEN event_id % 5 = 0 ELSE false END THEN 'skip_no_sensor_t0'
WHEN event_id % 7 = 0 THEN 'skip_existing_512' WHEN sensor <> 'EMIT' AND event_id % 11 = 0 THEN 'skip_existing_raw' ELSE 'download' END AS action FROM events, (SELECT unnest(['S2', 'L89', 'EMIT', 'S5P']) AS sensor), (SELECT unnest(['t0', 'prev1', 'prev2', 'prev3', 'seasonal', 'year']) AS timepoint) WHERE event_type = 'error'""")
def planning_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 24-slot grid and what each slot needs."""
    i = F.col("event_id")
    e = errors(spark, sf_dir).select("event_id", *[F.when(i % k == 0, "True").otherwise("no").alias(s) for s, k in (("S2", 2), ("L89", 3), ("EMIT", 5))])
    grid = planning.planning_grid(e, {s: s for s in ("S2", "L89", "EMIT")})
    path = lambda k: F.when(i % k == 0, "p")
    return grid.withColumn("action", planning.planned_action(F.col("sensor_has_t0"), path(7), path(11), F.col("sensor"))).select("event_id", "sensor", "timepoint", "action")


@query("""WITH m AS (SELECT l_orderkey, l_returnflag AS sensor, CAST(l_linenumber AS VARCHAR) AS timepoint, l_quantity > 25 AS ok FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linenumber ORDER BY l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1),
t AS (SELECT *, max(CASE WHEN timepoint = '1' THEN ok::INT ELSE 0 END) OVER (PARTITION BY l_orderkey, sensor) AS won FROM m) SELECT l_orderkey, sensor, CASE timepoint WHEN '1' THEN 't0' ELSE timepoint END AS timepoint, CASE WHEN timepoint = '1' THEN CASE WHEN ok THEN 't0_ok' ELSE 't0_failed' END WHEN won = 1 THEN 'proceed' ELSE 'skip_t0_failed' END AS gate FROM t""")
def t0_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12."""
    from eventloom.operators.windows import one_per_key

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("sensor"), F.when(F.col("l_linenumber") == 1, "t0").otherwise(F.col("l_linenumber").cast("string")).alias("timepoint"), "l_quantity", "l_partkey", "l_suppkey")
    rows = one_per_key(li, ["l_orderkey", "sensor", "timepoint"], ["l_partkey", "l_suppkey"])
    return planning.t0_gate(rows, "l_orderkey", F.col("l_quantity") > 25).select("l_orderkey", "sensor", "timepoint", "gate")


@query("""WITH s AS (SELECT c_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1), m AS (SELECT c_custkey, a, b, CAST(unnest(generate_series(date_trunc('month', a), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM s)
SELECT c_custkey, strftime(greatest(m, a), '%Y-%m-%d') AS window_start, strftime(least(last_day(m), b), '%Y-%m-%d') AS window_end FROM m""")
def month_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    s = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return planning.month_windows(s, "a", "b").select("c_custkey", day_text("window_start").alias("window_start"), day_text("window_end").alias("window_end"))


@query("""WITH u AS (SELECT l_orderkey, CASE WHEN l_quantity > 40 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS path, l_returnflag AS status, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_returnflag DESC) AS r FROM lineitem)
SELECT o_orderkey, CASE WHEN u.l_orderkey IS NOT NULL AND NOT (o_orderstatus = 'F' AND u.path IS NULL) THEN coalesce(u.path, CASE WHEN o_orderstatus = 'F' THEN 'old' END) ELSE CASE WHEN o_orderstatus = 'F' THEN 'old' END END AS path,
CASE WHEN u.l_orderkey IS NOT NULL AND NOT (o_orderstatus = 'F' AND u.path IS NULL) THEN u.status ELSE o_orderpriority END AS status FROM orders LEFT JOIN u ON o_orderkey = l_orderkey AND r = 1""")
def guarded_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last update of each key; a good path isn't overwritten by an update without one."""
    li = table(spark, sf_dir, "lineitem")
    updates = state.mapped_updates(li, {"o_orderkey": F.col("l_orderkey"), "seq": F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"), "path": F.when(F.col("l_quantity") <= 40, F.col("l_partkey").cast("string")), "status": "l_returnflag"}, F.lit(True))
    manifest = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "old").alias("path"), F.col("o_orderpriority").alias("status"))
    return state.guarded_upsert(manifest, updates, ["o_orderkey"], "seq", "path", ["path", "status"]).drop("changed")


@query("""SELECT l_orderkey, CAST(arg_max(l_partkey, l_linenumber * 100000000 + l_partkey) AS VARCHAR) AS path FROM lineitem WHERE l_quantity > 10 AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1""")
def completed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each key with an existing path."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_quantity") > 10, F.col("l_partkey").cast("string")).alias("path"), F.struct("l_linenumber", "l_partkey").alias("seq"))
    files = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.greatest(F.lit(0), F.col("p_size") - 10).alias("length"))
    return state.completed(li, ["l_orderkey"], "path", "seq", files).select("l_orderkey", "path")


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN s_suppkey IS NULL THEN 'unplanned' WHEN p_partkey % 7 = 0 THEN 'resume_done' WHEN p_partkey % 3 <> 0 THEN 'download' WHEN p_partkey % 2 = 0 THEN 'existing_valid' ELSE 'existing_mismatch' END AS status FROM part LEFT JOIN supplier ON p_partkey = s_suppkey) GROUP BY 1""")
def pull_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M07."""
    p, k = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name")), F.col("name")
    targets = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("name"), F.lit(2).alias("expected_length"))
    return state.pull_status(p, targets, p.where(k % 7 == 0), p.where(k % 3 == 0).withColumn("length", F.when(k % 2 == 0, 2).otherwise(3)), "name").groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events WHERE value > 100 AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = events.user_id AND e.event_type = events.event_type AND e.value < 5))""")
def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M08."""
    e = table(spark, sf_dir, "events")
    return state.append_usage(e.where("value < 5"), e.where("value > 100"), ("user_id", "event_type")).agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT d.doc_id, quality AS label, [CASE WHEN quality IS NOT NULL THEN quality = 1 END, CASE WHEN toxic IS NOT NULL THEN toxic = 0 END, n_chars > 1000] AS m FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s AS (SELECT *, len(list_filter(m, lambda x: x IS NOT NULL)) AS n, len(list_filter(m, lambda x: x)) AS p FROM v) SELECT doc_id, CAST(CASE WHEN n >= 2 AND p = n THEN 1 WHEN n >= 2 AND p = 0 THEN 0 WHEN n = 1 THEN p ELSE label END AS INT) AS new_label FROM s WHERE NOT (n >= 2 AND p > 0 AND p < n)""")
def mask_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q06: the corrective rules; conflicts go."""
    return quality.consensus(votes(spark, sf_dir), {x: x for x in "abc"}, "label", corrective=True).select("doc_id", "new_label")


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.select("doc_id", F.col("quality").alias("label"), (F.col("quality") == 1).alias("a"), (F.col("toxic") == 0).alias("b"), (F.col("n_chars") > 1000).alias("c"))


@query("""WITH s AS (SELECT quality AS label, (quality = 1)::INT + (toxic = 0)::INT + (n_chars > 1000)::INT AS p FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT CASE WHEN p = 3 THEN 'all_positive' WHEN p = 0 THEN 'all_zero' ELSE 'conflict' END AS consensus, count(*) AS n FROM s GROUP BY 1""")
def consensus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q05, G06."""
    return quality.consensus_counts(votes(spark, sf_dir), {x: x for x in "abc"}, "label")


@query("""SELECT page_id, nullif(array_to_string(list_filter([CASE WHEN length(html) < 3000 THEN 'short' END, CASE WHEN url NOT LIKE '%page=%' THEN 'no_page' END, CASE WHEN page_id % 9 = 0 THEN 'ninth' END], lambda x: x IS NOT NULL), ';'), '') AS reason FROM pages""")
def check_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q02, Q03: composed reason lists."""
    return table(spark, sf_dir, "pages").select("page_id", quality.reasons({"short": F.length("html") < 3000, "no_page": ~F.col("url").like("%page=%"), "ninth": F.col("page_id") % 9 == 0}).alias("reason"))


@query("""WITH c AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'S2' WHEN 'click' THEN 'L89' WHEN 'purchase' THEN 'EMIT' ELSE 'S5P' END AS sensor, value > 200 AS ok FROM events WHERE event_type <> 'error'), g AS (SELECT user_id, list_sort(list_distinct(coalesce(list(sensor) FILTER (ok), []))) AS v FROM c GROUP BY 1)
SELECT user_id, array_to_string(v, '+') AS valid, CAST(len(v) AS INT) AS num_valid_sensors, len(v) > 0 AS any_ok, list_contains(v, 'S2') OR list_contains(v, 'L89') OR list_contains(v, 'EMIT') AS raster_ok FROM g""")
def row_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q04, F10."""
    checks = products(spark, sf_dir).select("user_id", "sensor", (F.col("cloud") > 200).alias("ok"))
    return quality.verdicts(checks, "user_id", ["S2", "L89", "EMIT"]).select("user_id", F.array_join("valid_sensors", "+").alias("valid"), "num_valid_sensors", "any_ok", "raster_ok")


@query("""WITH l AS (SELECT DISTINCT sensor, path FROM (SELECT 'S2' AS sensor, 'p' || l_partkey AS path FROM lineitem UNION ALL SELECT 'L89', 'p' || l_suppkey FROM lineitem)), s AS (SELECT sensor, path, path IN (SELECT 'p' || p_partkey FROM part WHERE p_size > 25) AS ok FROM l) SELECT sensor, count(*) AS n_paths, count(*) FILTER (NOT ok) AS n_missing FROM s GROUP BY 1""")
def path_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q09, R03, J24, K03."""
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", name("l_partkey").alias("a"), name("l_suppkey").alias("b"))
    files = table(spark, sf_dir, "part").where("p_size > 25").select(name("p_partkey").alias("path"), F.lit(1).alias("length"))
    return quality.path_audit(li, ["l_orderkey"], {("S2", "t0"): "a", ("L89", "t0"): "b"}, files).drop("examples")


@query("""WITH w AS (SELECT l_orderkey, CASE WHEN l_discount >= 0.09 THEN 'zero' WHEN l_tax > 0.06 THEN 'missing' WHEN l_orderkey % 2 = 1 AND l_quantity < 5 THEN 'no_plume' WHEN l_orderkey % 2 = 0 AND l_quantity >= 45 THEN 'plume' END AS bad FROM lineitem)
SELECT l_orderkey, bool_and(bad IS NULL) AS ok, coalesce(string_agg(DISTINCT bad, ';' ORDER BY bad), '') AS reason FROM w GROUP BY 1""")
def crop_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10."""
    li = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_orderkey") % 2).cast("int"))
    li = li.withColumn("mask", F.when(F.col("label") == 1, F.when(F.col("l_quantity") < 5, 0).otherwise(1)).otherwise(F.when(F.col("l_quantity") >= 45, 1).otherwise(0)))
    return quality.crop_checks(li, ["l_orderkey"], "label", "l_discount", "l_tax", "mask", 0.09, 0.06)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'size_mismatch' WHEN o_totalprice > 300000 THEN 'shifted' ELSE 'centred' END AS alignment FROM orders""")
def alignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11."""
    size = F.when(F.col("o_orderkey") % 10 == 3, 500).otherwise(512)
    return quality.alignment(table(spark, sf_dir, "orders"), F.col("o_totalprice"), size, 512, 300000.0).select("o_orderkey", "alignment")


@query("""WITH d AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), o AS (SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
SELECT severity, code, detail FROM (SELECT 'warning' AS severity, 'negative_balance' AS code, CAST(count(*) AS VARCHAR) AS detail, count(*) AS n FROM d UNION ALL SELECT 'error', 'unknown_customer', CAST(count(*) AS VARCHAR), count(*) FROM o) WHERE n > 0""")
def manifest_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q08: rules to one table of issues."""
    c = table(spark, sf_dir, "customer")
    neg = c.where("c_acctbal < 0").agg(F.count("*").alias("n"))
    lost = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count("*").alias("n"))
    some = F.when(F.col("n") > 0, F.col("n"))
    return quality.issues([("warning", "negative_balance", neg, some), ("error", "unknown_customer", lost, some)])


@query("""WITH p AS (SELECT user_id, event_type, ts, value > 50 AS planned, true AS seen FROM events) SELECT user_id, bool_or(planned) AS planned, list_aggregate(list_sort(list_distinct(list(event_type))), 'string_agg', '+') AS evidence, epoch_us(arg_max(ts, event_id)) AS image_us FROM (SELECT user_id, event_type, ts, value > 50 AS planned, event_id FROM events) GROUP BY 1""")
def merged_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned and observed records to one."""
    e = table(spark, sf_dir, "events").withColumn("planned", F.col("value") > 50)
    out = master.combine_evidence(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["user_id"], ["planned"], "ts", "event_id", "event_type")
    return out.select("user_id", "planned", F.array_join("event_type", "+").alias("evidence"), F.unix_micros("ts").alias("image_us"))


@query("""SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_requests, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS slots FROM events GROUP BY 1, 2""")
def request_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G37."""
    e = table(spark, sf_dir, "events").select("user_id", day_text("ts").alias("day"), F.hour("ts").alias("hour"), "event_type")
    return master.request_groups(e, ["user_id", "day"], "hour", "event_type").select("user_id", "day", "n_requests", F.array_join("slots", "+").alias("slots"))


@query("""SELECT o_orderkey, 1 AS label, o_totalprice AS amount FROM orders UNION ALL SELECT o_orderkey, 0, CAST(o_custkey AS DOUBLE) FROM orders""")
def two_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R04."""
    o = table(spark, sf_dir, "orders").withColumn("other", F.col("o_custkey").cast("double"))
    return master.two_labels(o, ["o_orderkey"], ["o_totalprice"], ["other"], ["amount"])


@query("""SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) FILTER (r = 1) AS "A_l_quantity", max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) FILTER (r = 1) AS "R_l_quantity" FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_partkey * 1000000 + l_suppkey * 10 + l_linenumber, l_quantity) AS r FROM lineitem) GROUP BY 1""")
def long_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R05."""
    li = table(spark, sf_dir, "lineitem").withColumn("o", F.struct(F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber"), F.col("l_quantity")))
    return master.long_to_wide(li, ["l_orderkey"], "l_returnflag", ["A", "R"], ["l_quantity"], "o")


@query("""WITH c AS (SELECT o_orderkey, (CASE WHEN o_totalprice <= 200000 THEN 1 ELSE 0 END) + (CASE WHEN o_custkey % 100 <= 20 THEN 1 ELSE 0 END) AS n FROM orders) SELECT n AS n_valid, count(*) AS k FROM c WHERE n > 0 GROUP BY 1""")
def cloud_invalidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cloudy slots nulled, rows with any left kept."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_custkey") % 100).alias("c2"), F.lit("a").alias("p1"), F.lit("b").alias("p2"))
    return master.invalidate_cloudy(o.withColumn("c1", F.col("o_totalprice") / 10000), {"one": ("c1", ["p1"]), "two": ("c2", ["p2"])}, 20.0).groupBy("n_valid").agg(F.count("*").alias("k"))


@query("""SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS lang, '' AS missing, coalesce(CAST(n_chars AS VARCHAR), '') AS n_chars FROM documents""")
def manifest_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed fields as text."""
    return sinks.manifest_form(table(spark, sf_dir, "documents"), ["doc_id", "lang", "missing", "n_chars"]).withColumn("doc_id", F.col("doc_id").cast("long"))


@query("""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, 'a' || (page_id % 7) AS archive FROM pages""")
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A08 on pages: fields out of documents, the first archive of each member."""
    p = table(spark, sf_dir, "pages")
    members = p.select(F.col("page_id").alias("member"), F.concat(F.lit("a"), (F.col("page_id") % 7).cast("string")).alias("archive"))
    more = members.unionByName(members.withColumn("archive", F.lit("z")))
    return p.select(F.col("page_id").alias("member"), names.extract("html", "<title>([^<]*)</title>").alias("t"), F.lit("").alias("e")).join(scans.member_index(more), "member").select(F.col("member").alias("page_id"), F.coalesce("t", "e").alias("title"), "archive")


@query(f"""WITH d AS (SELECT event_id, unnest([1, 0]) AS label FROM events WHERE event_type = 'error'), e AS (SELECT event_id, label, unnest([1, 2, 3]) AS draw FROM d)
SELECT event_id, label, draw, CAST(-60 + floor({HASH_SQL.format("event_id || ':' || label || ':' || draw || ':x'")} * 120) AS INT) AS dx, CAST(-60 + floor({HASH_SQL.format("event_id || ':' || label || ':' || draw || ':y'")} * 120) AS INT) AS dy FROM e""")
def offset_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible draws per event and label."""
    return splits.draws(errors(spark, sf_dir).select("event_id"), "event_id", 3, -60, 60, labels=(1, 0))
