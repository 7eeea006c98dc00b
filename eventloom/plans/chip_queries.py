"""Further queries: composed chip operators, names and paths, candidate windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions import clean, geo, names
from eventloom.operators import chips as C, master, planning, quality, splits, state
from eventloom.plans.registry import chips, errors, points, query, table
from eventloom.plans.report_queries import HASH_SQL
from eventloom.plans.stats_queries import PIXELS


def total(c: Column | str) -> Column:
    return F.round(F.aggregate(c, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))), 5)


@query("WITH " + PIXELS + ", g AS (SELECT chip_id, i, CASE WHEN abs(v) > 0.02 THEN v END AS v FROM px) SELECT chip_id, count(v) AS known, round(coalesce(sum(v), 0), 5) AS total FROM g GROUP BY 1")
def known_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small values to missing, what is left."""
    c = chips(spark, sf_dir).withColumn("m", C.to_missing(F.transform("px", lambda v: F.when(F.abs(v) > 0.02, v).otherwise(F.lit(-9999.0))), fills=[-9999.0]))
    return c.select("chip_id", F.round(64 * (1 - C.share_missing("m")), 0).cast("long").alias("known"), total("m").alias("total"))


@query("WITH " + PIXELS + " SELECT a.chip_id, round(sum((a.v - b.v) / nullif(a.v + b.v, 0) - (b.v - a.v) / nullif(b.v + a.v, 0)), 1) AS total FROM px a JOIN px b ON b.chip_id = a.chip_id + 1 AND a.i = b.i WHERE abs(a.v + b.v) > 0.05 GROUP BY 1")
def ratio_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band ratios of a chip and its successor, now less then."""
    a = chips(spark, sf_dir).select("chip_id", "px")
    pair = a.join(a.select((F.col("chip_id") - 1).alias("chip_id"), F.col("px").alias("next")), "chip_id")
    d = C.band_ratio_difference("px", "next", "next", "px")
    large = F.zip_with(F.zip_with("px", "next", lambda x, y: F.abs(x + y) > 0.05), d, lambda ok, v: F.when(ok, v))
    # The sum is rounded once, at the end; a chip without any such pixel has no row, and one id has one row.
    kept = pair.select("chip_id", F.filter(large, lambda v: v.isNotNull()).alias("kept")).where(F.size("kept") > 0)
    return kept.groupBy("chip_id").agg(F.round(F.sum(F.aggregate("kept", F.lit(0.0), lambda s, v: s + v)), 1).alias("total"))


@query("WITH " + PIXELS + " SELECT chip_id // 3 AS k, round(sum(v), 4) AS total, count(*) AS n FROM px WHERE chip_id // 3 IN (SELECT chip_id // 3 FROM px GROUP BY 1 HAVING count(DISTINCT chip_id) = 3) GROUP BY 1")
def stacked_chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three chips of a key as one stack, where all three are there."""
    c = chips(spark, sf_dir).select(F.floor(F.col("chip_id") / 3).alias("k"), (F.col("chip_id") % 3).cast("int").alias("o"), "px")
    s = state.stack_offsets(c, ["k"], "o", [0, 1, 2], "px")
    return s.select("k", F.round(F.aggregate(F.flatten("stack"), F.lit(0.0), lambda a, v: a + v), 4).alias("total"), F.size(F.flatten("stack")).cast("long").alias("n"))


@query("WITH " + PIXELS + " SELECT chip_id, round(sum(CASE WHEN i // 8 BETWEEN 2 AND 5 AND i % 8 BETWEEN 2 AND 5 THEN v ELSE 0 END), 5) AS inner_total, round(sum(v), 5) AS padded_total, round(sum(v * 0.5 + 0.25), 5) AS scaled FROM px GROUP BY 1")
def cropped_and_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre crop, placement on a larger grid, linear rescale."""
    return chips(spark, sf_dir).select("chip_id", total(C.crop_or_pad("px", "height", "width", 4)).alias("inner_total"), total(C.place_on_grid("px", "height", "width", 16, 2, -3)).alias("padded_total"), total(C.rescale("px", 0.5, 0.25)).alias("scaled"))


@query(f"""WITH {PIXELS}, d AS (SELECT vec_id AS chip_id, unnest([1, 2, 3]) AS draw FROM embeddings), w AS (SELECT chip_id, draw, CAST(floor({HASH_SQL.format("chip_id || ':1:' || draw || ':x'")} * 6) AS INT) AS x, CAST(floor({HASH_SQL.format("chip_id || ':1:' || draw || ':y'")} * 6) AS INT) AS y FROM d),
s AS (SELECT w.chip_id, draw, x, y, count(*) FILTER (v < 0.05) / 9.0 AS low FROM w JOIN px ON px.chip_id = w.chip_id AND i // 8 BETWEEN y AND y + 2 AND i % 8 BETWEEN x AND x + 2 GROUP BY 1, 2, 3, 4), r AS (SELECT *, row_number() OVER (PARTITION BY chip_id ORDER BY draw) AS r FROM s WHERE low < 0.6) SELECT chip_id, draw, x, y FROM r WHERE r <= 2""")
def drawn_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible draws, window checks, the first two valid ones."""
    rows = splits.draws(chips(spark, sf_dir), "chip_id", 3, 0, 6).withColumnsRenamed({"dx": "x", "dy": "y"})
    low = C.share_zero(F.transform(C.crop("px", "height", "width", "y", "x", 3, 3), lambda v: F.when(v >= 0.05, v).otherwise(0.0)))
    return splits.first_valid_draws(rows.drop("label").withColumn("label", F.lit(1)), "chip_id", 2, low < 0.6).select("chip_id", "draw", "x", "y")


def _drawn_sql(axis: str) -> str:
    return f"CAST(floor({HASH_SQL.format(f"event || ':' || label || ':' || draw || ':{axis}'")} * 160) AS INT) - 80"


@query(f"""WITH {PIXELS}, c AS (SELECT vec_id AS chip_id, vec_id // 2 AS event, CASE WHEN vec_id % 2 = 0 THEN 'S2' ELSE 'L89' END AS sensor, CASE WHEN vec_id % 2 = 0 THEN 10.0 ELSE 30.0 END AS g, CASE WHEN vec_id % 2 = 0 THEN 3 ELSE 1 END AS p FROM embeddings),
a AS (SELECT event, label, draw FROM (SELECT DISTINCT event FROM c), (VALUES (1, 12), (0, 8)) AS l(label, most), (SELECT unnest(range(1, 13)) AS draw) WHERE draw <= most), d AS (SELECT event, label, draw, {_drawn_sql("x")} AS dx, {_drawn_sql("y")} AS dy FROM a),
t AS (SELECT d.*, sensor, chip_id, p, round_even(4 - dy / g, 0) - p // 2 AS y, round_even(4 + dx / g, 0) - p // 2 AS x FROM d JOIN c USING (event)),
s AS (SELECT event, label, draw, dx, dy, sensor, p, count(q.i) FILTER (v <= 0) AS zero, count(q.i) AS n FROM t LEFT JOIN (SELECT chip_id, i, v FROM px) q ON q.chip_id = t.chip_id AND i // 8 BETWEEN y AND y + p - 1 AND i % 8 BETWEEN x AND x + p - 1 GROUP BY ALL),
o AS (SELECT event, label, draw, dx, dy, string_agg(sensor, '+' ORDER BY sensor) AS sensors FROM s GROUP BY ALL HAVING bool_and(n = p * p AND zero < 0.5 * p * p)), r AS (SELECT *, row_number() OVER (PARTITION BY event, label ORDER BY draw) AS r FROM o)
SELECT event, label, draw, dx, dy, sensors FROM r WHERE r <= CASE label WHEN 1 THEN 3 ELSE 2 END""")
def aligned_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 3 and 2 draws of an event, of 12 and 8, whose windows pass in all of its sensors' chips."""
    c = chips(spark, sf_dir)
    both = c.select(F.floor(F.col("chip_id") / 2).alias("event"), F.when(F.col("chip_id") % 2 == 0, "S2").otherwise("L89").alias("sensor"), "height", "width", F.transform("px", lambda v: F.greatest(v, F.lit(0.0))).alias("px"))
    passed = lambda drawn: C.aligned_samples(drawn, both, "event", ["S2", "L89"], 30.0, 8, 0.5).where("ok")
    out = splits.quota_draws(both.select("event").distinct(), "event", {1: 3, 0: 2}, {1: 12, 0: 8}, passed, -80, 80)
    return out.select("event", "label", "draw", "dx", "dy", F.array_join("sensors", "+").alias("sensors"))


@query(f"""WITH {PIXELS}, e AS (SELECT vec_id AS event, vec_id - 1 AS chip_id, vec_id % 5 AS y, vec_id % 4 AS x FROM embeddings WHERE vec_id - 1 IN (SELECT vec_id FROM embeddings)),
o AS (SELECT event, chip_id, y, x, 0 AS part, 0 AS ord, y AS ny, x AS nx FROM e UNION ALL SELECT event, chip_id, y, x, 1, -((b - y) * (b - y) + (a - x) * (a - x)), CASE WHEN b > 0 THEN 5 ELSE 0 END, CASE WHEN a > 0 THEN 5 ELSE 0 END FROM e, (VALUES (0, 0), (0, 8), (8, 0), (8, 8)) AS k(b, a)),
z AS (SELECT o.event, part, ord, ny, nx, count(*) FILTER (v <= 0) AS zero FROM o JOIN px ON px.chip_id = o.chip_id AND i // 8 BETWEEN ny AND ny + 2 AND i % 8 BETWEEN nx AND nx + 2 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY part, ord, ny, nx) AS r FROM z WHERE zero < 4.5)
SELECT e.event, CAST(e.y AS INT) AS y, CAST(e.x AS INT) AS x, 3 AS h, CAST(ny AS INT) AS neg_y, CAST(nx AS INT) AS neg_x, r.event IS NOT NULL AS found FROM e LEFT JOIN r ON r.event = e.event AND r.r = 1""")
def paired_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows one chip earlier, corners where those are poor."""
    c = chips(spark, sf_dir)
    positive = c.select(F.col("chip_id").alias("event"), (F.col("chip_id") % 5).cast("int").alias("y"), (F.col("chip_id") % 4).cast("int").alias("x"), F.lit(3).alias("h"))
    earlier = c.select((F.col("chip_id") + 1).alias("event"), "height", "width", F.transform("px", lambda v: F.greatest(v, F.lit(0.0))).alias("px"))
    return C.paired_negatives(positive, earlier, "event", 0.5, 8)


@query(f"""WITH {PIXELS}, c AS (SELECT vec_id AS chip_id, label, vec_id % 7 AS day FROM embeddings), z AS (SELECT chip_id, count(*) FILTER (v <= 0) / 64.0 AS zero FROM px GROUP BY 1),
r AS (SELECT c.*, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL.format('c.chip_id')}, c.chip_id) AS r FROM c JOIN z USING (chip_id) WHERE zero <= 0.6 AND NOT EXISTS (SELECT 1 FROM c d WHERE d.day = 3 AND d.label = c.label AND d.day = c.day))
SELECT chip_id, 0 AS band, 8 AS height, 8 AS width, label, day FROM r WHERE r <= 3""")
def tile_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well filled chips of labels not done, three a label at most."""
    c = chips(spark, sf_dir).withColumn("day", F.col("chip_id") % 7).withColumn("px", F.transform("px", lambda v: F.greatest(v, F.lit(0.0))))
    return C.tile_samples(c, "label", "day", "chip_id", "px", c.where("day = 3").select("label", "day"), 0.6, 3).drop("px")


@query(f"""WITH {PIXELS}, n AS (SELECT chip_id, i // 8 AS y, i % 8 AS x, v < -0.12 AS bad FROM px), e AS (SELECT vec_id AS chip_id, vec_id % 8 AS py, vec_id % 7 AS qx FROM embeddings),
c AS (SELECT chip_id, py, qx, 0 AS part, -((cy - py) * (cy - py) + (cx - qx) * (cx - qx)) AS o, cy, cx FROM e, (VALUES (1, 1), (1, 6), (6, 1), (6, 6)) AS t(cy, cx)
UNION ALL SELECT chip_id, py, qx, 1, k, 1 + CAST(floor({HASH_SQL.format("chip_id || ':' || k || ':y'")} * 6) AS INT), 1 + CAST(floor({HASH_SQL.format("chip_id || ':' || k || ':x'")} * 6) AS INT) FROM e, (SELECT unnest(range(1, 21)) AS k)),
s AS (SELECT c.chip_id, part, o, cy, cx, count(*) FILTER (bad) AS n_bad FROM c JOIN n ON n.chip_id = c.chip_id AND y BETWEEN cy - 1 AND cy + 1 AND x BETWEEN cx - 1 AND cx + 1 WHERE NOT (abs(cy - py) <= 2 AND abs(cx - qx) <= 2) GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, row_number() OVER (PARTITION BY chip_id ORDER BY part, o, cy, cx) AS r FROM s WHERE n_bad <= 2) SELECT e.chip_id, CAST(r.cy AS INT) AS cy, CAST(r.cx AS INT) AS cx FROM e LEFT JOIN r ON r.chip_id = e.chip_id AND r.r = 1""")
def negative_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of negatives: corners first, then draws, outside of the plume and not too empty."""
    c = chips(spark, sf_dir).withColumn("px", F.transform("px", lambda v: F.when(v >= -0.12, v))).withColumn("y", (F.col("chip_id") % 8).cast("int")).withColumn("x", (F.col("chip_id") % 7).cast("int"))
    out = C.negative_centres(c, "px", "height", "width", 1, "y", "x", "chip_id", 2, 0.25, 20)
    return out.select("chip_id", F.col("negative.cy").alias("cy"), F.col("negative.cx").alias("cx"))


@query("""WITH b AS (SELECT p_partkey AS band_idx, 400 + (p_partkey * 7919) % 2100 AS nm FROM part), l AS (SELECT *, row_number() OVER (ORDER BY nm, band_idx) - 1 AS r, count(*) OVER () AS n FROM b WHERE nm BETWEEN 400 AND 1200), h AS (SELECT *, row_number() OVER (ORDER BY nm, band_idx) - 1 AS r, count(*) OVER () AS n FROM b WHERE nm BETWEEN 2000 AND 2499)
SELECT band_idx, nm, 'low' AS part FROM l WHERE r IN (SELECT CAST(round_even(k * (n - 1) / 7.0, 0) AS BIGINT) FROM range(8) t(k)) UNION ALL SELECT band_idx, nm, 'core' FROM b WHERE nm BETWEEN 1500 AND 1520 UNION ALL SELECT band_idx, nm, 'high' FROM h WHERE r IN (SELECT CAST(round_even(k * (n - 1) / 4.0, 0) AS BIGINT) FROM range(5) t(k))""")
def picked_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bands of the core window, evenly spaced ones of the others."""
    bands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("band_idx"), (400 + (F.col("p_partkey") * 7919) % 2100).alias("nm"))
    return C.pick_bands(bands, (400, 1200), (1500, 1520), (2000, 2499), 8, 5, "nm")


def tile_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well filled chips of labels not done, three a label at most."""
    c = chips(spark, sf_dir).withColumn("day", F.col("chip_id") % 7).withColumn("px", F.transform("px", lambda v: F.greatest(v, F.lit(0.0))))
    return C.tile_samples(c, "label", "day", "chip_id", "px", c.where("day = 3").select("label", "day"), 0.6, 3).drop("px")


@query("""SELECT c_custkey, 'POLYGON((' || CAST(w AS VARCHAR) || ' 1.0,' || CAST(w + 2 AS VARCHAR) || ' 1.0,' || CAST(w + 2 AS VARCHAR) || ' 4.0,' || CAST(w AS VARCHAR) || ' 4.0,' || CAST(w AS VARCHAR) || ' 1.0))' AS wkt FROM (SELECT c_custkey, (c_custkey % 90)::DOUBLE AS w FROM customer)""")
def box_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds texts to boxes to polygons."""
    k = F.col("c_custkey") % 90
    text = F.concat(F.lit("["), k.cast("string"), F.lit(",1,"), (k + 2).cast("string"), F.lit(",4]"))
    return table(spark, sf_dir, "customer").select("c_custkey", geo.box_polygon(geo.parse_bounds(text, F.lit(0.0), F.lit(0.0))).alias("wkt"))


@query("""SELECT p_partkey, 'LC08|' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '|20240102' AS overpass, lpad(CAST(p_size AS VARCHAR), 3, '0') AS wrs_path, 'a/' || p_brand || '/x.tif' AS path, CASE WHEN p_partkey % 2 = 0 THEN '360' ELSE '90;360' END AS needed, 'OFFL' AS level FROM part""")
def scene_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24, P30, P32, P33."""
    scene = F.format_string("LC08_L2SP_%03d034_20240102_20240110_02_T1", F.col("p_size"))
    s = names.scene_fields(scene)
    return table(spark, sf_dir, "part").select(
        "p_partkey", names.overpass_l89(s["spacecraft"], s["wrs_path"], s["acquired"]).alias("overpass"), s["wrs_path"].alias("wrs_path"), names.path_of("a/", F.col("p_brand"), "x.tif").alias("path"),
        names.needed_offsets({90: F.col("p_partkey") % 2 == 0, 360: F.lit(False)}).alias("needed"), names.processing_level(F.concat(F.lit("S5P_OFFL_"), F.col("p_brand"))).alias("level"),
    )


@query("""WITH f AS (SELECT p_partkey AS path, p_size AS h FROM part WHERE p_size > 5), l AS (SELECT o_orderkey, unnest([o_orderkey % 2500, (o_orderkey * 7) % 2500]) AS path FROM orders), j AS (SELECT o_orderkey, h FROM l LEFT JOIN f USING (path)),
g AS (SELECT o_orderkey, count(*) FILTER (h IS NULL) AS a, count(*) FILTER (h <> 30) AS o, count(DISTINCT h) AS s FROM j GROUP BY 1) SELECT o_orderkey, array_to_string(list_filter([CASE WHEN a > 0 THEN 'missing_file' END, CASE WHEN o > 0 THEN 'wrong_size' END, CASE WHEN s > 1 THEN 'mixed_shapes' END], lambda x: x IS NOT NULL), ';') AS reason FROM g WHERE a > 0 OR o > 0 OR s > 1""")
def triplet_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q01: images given, there, of the size and of one shape."""
    text = lambda c: (c % 2500).cast("string")
    o = table(spark, sf_dir, "orders").select("o_orderkey", text(F.col("o_orderkey")).alias("a"), text(F.col("o_orderkey") * 7).alias("b"))
    files = table(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").cast("string").alias("path"), F.col("p_size").alias("height"), F.lit(1).alias("width"), F.lit("f4").alias("dtype"))
    got = quality.triplet_check(o, ["o_orderkey"], ["a", "b"], files.withColumn("width", F.col("height")), 30)
    return got.where("reason is not null").select("o_orderkey", "reason")


@query("""SELECT event_id, sensor, timepoint, CASE WHEN event_id % 4 = 1 OR timepoint = 'prev1' THEN 'download' ELSE 'have' END AS action FROM events, (VALUES ('S2'), ('L89')) AS s(sensor), (VALUES ('t0'), ('prev1')) AS t(timepoint) WHERE event_type = 'error' AND event_id % 4 IN (1, 2)""")
def fetch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to fetch: the missing ones and their events' t0."""
    e = errors(spark, sf_dir).select("event_id", F.explode(F.array(F.lit("S2"), F.lit("L89"))).alias("sensor"))
    m = e.withColumn("timepoint", F.explode(F.array(F.lit("t0"), F.lit("prev1")))).withColumn("action", F.when(F.col("event_id") % 4 == 1, "download").when((F.col("event_id") % 4 == 2) & (F.col("timepoint") == "prev1"), "download").otherwise("have"))
    return planning.rows_to_fetch(m, "event_id", F.col("action") == "download").select("event_id", "sensor", "timepoint", "action")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a' || o_custkey WHEN o_orderkey % 3 = 1 THEN 'b' END AS first, array_to_string(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'S2' END, CASE WHEN o_orderkey % 2 = 0 THEN 'L89' END], lambda x: x IS NOT NULL), '+') AS sensors FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0""")
def complete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a complete sensor."""
    i = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(i % 3 == 0, F.concat(F.lit("a"), F.col("o_custkey").cast("string"))).otherwise("nan").alias("a"), F.when(i % 3 == 1, "b").otherwise(" ").alias("b"), F.when(i % 2 == 0, "p").alias("c"))
    out = master.complete_triplets(o, {"S2": ["a"], "L89": ["c"]})
    return out.select("o_orderkey", clean.first_value(["a", "b"], "path").alias("first"), F.array_join("valid_sensors", "+").alias("sensors"))


@query("""WITH ROLES SELECT pid, CAST(round_even(4 - lat * 10 / 30.0, 0) - 1 AS INT) AS y, CAST(round_even(4 + lon * 10 / 30.0, 0) - 1 AS INT) AS x FROM cu""")
def aligned_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metre offsets to a window's corner."""
    p = points(spark, sf_dir).withColumn("t", geo.top_left(F.col("lon") * 10, F.col("lat") * 10, F.lit("L89"), 90.0, 8))
    return p.select("pid", F.col("t.y").alias("y"), F.col("t.x").alias("x"))
