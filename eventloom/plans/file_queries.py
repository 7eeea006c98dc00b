"""Queries of scans and sinks, and of functions that files and names need: each writes what it reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.functions import clean, geo, names, temporal
from eventloom.operators import chips as chip, cover, master, planning, quality, report, splits, state, windows
from eventloom.plans.registry import chips, points, products, query, sites, table
from eventloom.plans.report_queries import HASH_SQL
from eventloom.scratch import Scratch
from eventloom.sources import scans, sinks


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a manifest of CSV files, its clerk quoted and with a comma."""
    path = Scratch(spark).path()
    orders = table(spark, sf_dir, "orders").withColumn("clerk", F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('", ok')))
    sinks.write_manifest(orders, path, ["o_orderkey", "o_custkey", "o_orderstatus", "clerk", "absent"])
    return path


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, 'say "' || o_orderstatus || '", ok' AS clerk, CAST(NULL AS VARCHAR) AS absent FROM orders""")
def scanned_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest written and read, every field text; blanks are null again."""
    return scans.manifest(spark, _orders_csv(spark, sf_dir))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS event, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1""")
def projected_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns, renamed, the first order of each customer."""
    rows = scans.manifest(spark, _orders_csv(spark, sf_dir)).withColumn("place", F.col("o_orderkey").cast("long"))
    return scans.projected(rows, ["o_custkey", "o_orderstatus", "nowhere"], {"o_custkey": "event", "o_orderstatus": "status"}, "o_custkey", ["place"])


@query("""SELECT c_custkey, o.o_orderstatus AS status, CAST(NULL AS VARCHAR) AS old_status FROM customer LEFT JOIN (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) o ON c_custkey = o_custkey""")
def looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look-up table from a file, and one whose file is absent."""
    found = scans.lookup_or_empty(spark, _orders_csv(spark, sf_dir), "o_custkey string, o_orderkey string, o_orderstatus string").withColumn("place", F.col("o_orderkey").cast("long"))
    absent = scans.lookup_or_empty(spark, Scratch(spark).path(), "o_custkey string, o_orderstatus string")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("o_custkey"))
    both = master.lookup(master.lookup(customers, found, "o_custkey", ["place"]), absent, "o_custkey", ["o_orderstatus"], "old_")
    return both.select("c_custkey", F.col("o_orderstatus").alias("status"), F.col("old_o_orderstatus").alias("old_status"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS brand FROM supplier UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, NULL, p_brand FROM part""")
def catalogue_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogues of different headers, one below the other."""
    a, b = Scratch(spark).path(), Scratch(spark).path()
    sinks.write_manifest(table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_nationkey as nation"), a, ["id", "name", "nation"])
    sinks.write_manifest(table(spark, sf_dir, "part").selectExpr("p_partkey as id", "p_name as name", "p_brand as brand"), b, ["id", "name", "brand"])
    return scans.catalogue(spark, [a, b])


@query("""SELECT coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'unassigned') AS split, count(*) AS n FROM orders GROUP BY 1""")
def split_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each split, counted through the inventory of its files."""
    path = Scratch(spark).path()
    sinks.write_splits(table(spark, sf_dir, "orders").withColumn("split", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))), path)
    files = scans.inventory(spark, path, "*.parquet").where("length > 0")
    old = scans.older_than(files, 3600, F.current_timestamp() + F.expr("interval 2 hours")).select(names.extract("path", "/split=([^/]+)/").alias("split")).distinct()
    young = scans.older_than(files, 3600).select(names.extract("path", "/split=([^/]+)/").alias("split")).distinct()
    counts = spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"))
    return master.not_done(counts.join(old, "split"), young, ["split"])


@query("""SELECT 'd/' || CASE WHEN p_partkey % 3 = 0 THEN 'pos' ELSE 'neg' END || '_' || p_size || '_' || (p_partkey - 50) AS folder, (p_partkey % 3 = 0)::INT AS label, p_size AS x, CAST(p_partkey - 50 AS INT) AS y FROM part WHERE p_partkey % 5 <> 0""")
def folder_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and offsets from folder names, whole sample folders only."""
    k = F.col("p_partkey")
    folder = F.concat(F.lit("d/"), F.when(k % 3 == 0, "pos").otherwise("neg"), F.lit("_"), F.col("p_size").cast("string"), F.lit("_"), (k - 50).cast("string"))
    files = F.array_compact(F.array(F.lit("a.npz"), F.when(k % 5 != 0, "mask.npz"), F.lit("log.txt")))
    rows = table(spark, sf_dir, "part").select(F.explode(F.transform(files, lambda f: F.concat(folder, F.lit("/"), f))).alias("path"))
    return scans.folders_to_manifest(rows, ["a.npz", "mask.npz"])


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 4 = 2 AND o_orderstatus = 'F'""")
def released_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split of a release, by scheme, scale and split."""
    scale = F.element_at(F.array(*[F.lit(x) for x in scans.SCALES]), (F.col("o_custkey") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "temporal").otherwise("geographic").alias("scheme"), scale.alias("scale"), F.when(F.col("o_orderstatus") == "F", "test").otherwise("train").alias("split"))
    return scans.released_split(rows, "temporal", "480m", "test").select("o_orderkey")


@query("""SELECT p_partkey, list_aggregate(list_filter([CASE WHEN p_size % 3 = 0 THEN 'EMIT' END, CASE WHEN p_size % 2 = 0 THEN 'S2' END], lambda x: x IS NOT NULL), 'string_agg', '+') AS sensors, CASE WHEN p_size % 2 = 0 THEN 's2/' || p_partkey END AS s2_image,
CASE WHEN p_size % 2 = 0 AND p_size % 5 > 0 THEN 1 WHEN p_size % 2 = 0 THEN 0 END AS s2_masks, p_size % 2 AS label FROM part""")
def assembled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sensors both available and asked for, with the paths they have."""
    z, key = F.col("p_size"), F.col("p_partkey").cast("string")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws(" ", F.when(z % 2 == 0, "sentinel-2"), F.when(z % 3 == 0, "emit"), F.lit("L8")).alias("have"), F.concat(F.lit("s2/"), key).alias("s2"), F.when(z % 5 > 0, F.concat(F.lit("m/"), key)).otherwise("").alias("m"),
        F.concat(F.lit("e/"), key).alias("e"), (z % 2).cast("string").alias("label"),
    )
    out = scans.samples(rows, ["S2", "EMIT"], "have", {"S2": {"image": "s2", "mask": "m"}, "EMIT": {"image": "e"}})
    s2 = F.try_element_at("sensor_paths", F.lit("S2"))
    return out.select("p_partkey", F.nullif(F.array_join(F.array_sort("sensors"), "+"), F.lit("")).alias("sensors"), s2["image"].alias("s2_image"), F.when(s2.isNotNull(), F.size(F.map_filter(s2, lambda k, _: k == "mask"))).alias("s2_masks"), "label")


@query("""SELECT page_id, page_id % 100 / 2.0 AS cloud, 'T' || page_id AS tile, 2 AS n_points, round(page_id % 90 + 0.5, 2) AS lat FROM pages""")
def xml_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and footprint of XML metadata."""
    i = F.col("page_id")
    xml = F.concat(F.lit("<p><cloud>"), (i % 100 / 2.0).cast("string"), F.lit("</cloud><tile>T"), i.cast("string"), F.lit("</tile><pos>"), (i % 90 + 0.5).cast("string"), F.lit(" 10 20 30</pos></p>"))
    read = scans.xml_metadata(table(spark, sf_dir, "pages").select("page_id", xml.alias("xml")), "xml", {"cloud": "p/cloud", "tile": "p/tile", "pos": "p/pos"})
    at = scans.footprint_of("pos")
    return read.select("page_id", F.col("cloud").cast("double").alias("cloud"), "tile", F.size(at).alias("n_points"), F.round(at[0]["lat"], 2).alias("lat"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS file, p_name AS "NAME", CAST(p_size AS VARCHAR) AS "SUN_ELEVATION", CAST(NULL AS VARCHAR) AS "ABSENT" FROM part""")
def key_value_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KEY = VALUE lines to columns, quotes gone."""
    lines = F.array(F.lit("GROUP = HEAD"), F.concat(F.lit('  NAME = "'), F.col("p_name"), F.lit('"')), F.concat(F.lit("  SUN_ELEVATION = "), F.col("p_size").cast("string")), F.lit("END"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("file"), F.explode(lines).alias("text"))
    return scans.key_values(rows, "file", "text", ["NAME", "SUN_ELEVATION", "ABSENT"])


@query("""SELECT 3 AS version, s_suppkey, s_nationkey + 1 AS value FROM supplier""")
def newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table rewritten three times; readers see the last whole version."""
    root, rows = Scratch(spark).path(), table(spark, sf_dir, "supplier")
    for k in (3, 2, 7, 1):
        n = state.write_version(rows.select("s_suppkey", (F.col("s_nationkey") + k).alias("value")), root)
    return state.read_version(spark, root).select(F.lit(n).alias("version"), "s_suppkey", "value")


@query("""SELECT '{"max_size":' || printf('%.1f', CAST(max(p_size) AS DOUBLE)) || ',"rows":' || printf('%.1f', CAST(count(*) AS DOUBLE)) || '}' AS value FROM part UNION ALL SELECT '{"rows":' || printf('%.1f', CAST(count(*) AS DOUBLE)) || '}' FROM supplier""")
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written as JSON documents and read again."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    metrics = report.metrics_long({"part": part.agg(F.count("*").alias("rows"), F.max("p_size").alias("max_size")), "supplier": supplier.agg(F.count("*").alias("rows"))})
    path = Scratch(spark).path()
    sinks.write_report(report.as_json(metrics), path)
    return spark.read.text(path)


@query("""SELECT CASE k WHEN 0 THEN '# Manifest report' WHEN 1 THEN '' WHEN 2 THEN '- part rows: ' || printf('%.1f', (SELECT CAST(count(*) AS DOUBLE) FROM part)) ELSE '- **error** few_rows: ' || (SELECT count(*) FROM part) END AS line FROM (SELECT unnest([0, 1, 2, 3]) AS k)""")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as Markdown lines."""
    rows = table(spark, sf_dir, "part").agg(F.count("*").alias("rows"))
    return report.as_markdown(report.metrics_long({"part": rows}), quality.issues([("error", "few_rows", rows, F.col("rows")), ("error", "none", rows, F.lit(None))])).select("line")


@query("""WITH ROLES SELECT pid, round(6371.0 * sqrt(pow(x * cos(radians(lat + 5) / 2), 2) + pow(radians(5 - lat), 2)), 3) AS km, region FROM (SELECT pid, lat, radians(((10 - lon) + 180) - 360 * floor(((10 - lon) + 180) / 360) - 180) AS x,
CASE WHEN lat BETWEEN 10 AND 60 AND lon BETWEEN -130 AND -60 THEN 'north' WHEN lat <= -10 AND (lon >= 150 OR lon <= -150) THEN 'date_line' END AS region FROM cu)""")
def flat_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat distances, and points in named boxes."""
    regions = {"north": geo.box(F.lit(-130.0), F.lit(10.0), F.lit(-60.0), F.lit(60.0)), "date_line": geo.box(F.lit(150.0), F.lit(-90.0), F.lit(-150.0), F.lit(-10.0))}
    return points(spark, sf_dir).select("pid", F.round(geo.flat_km(F.col("lat"), F.col("lon"), F.lit(5.0), F.lit(10.0)), 3).alias("km"), geo.region_of(F.col("lat"), F.col("lon"), regions).alias("region"))


@query("""SELECT product_id, CASE WHEN product_id % 3 = 0 THEN lpad(CAST(product_id % 100000 AS VARCHAR), 5, '0') ELSE strftime(acq_time, '%Y%m%d') END AS s5p, CASE WHEN product_id % 2 = 0 THEN lpad(CAST(product_id AS VARCHAR), 7, '0') ELSE 'x' || product_id END AS emit,
'ang' || strftime(acq_time, '%Y%m%dt%H%M%S') AS grp, '%_' || strftime(acq_time, '%Y%m%dT%H%M%S') || '_%' AS granule, CAST(product_id % 100000 AS INT) AS orbit, CASE product_id % 4 WHEN 0 THEN 'S5P' WHEN 1 THEN 'S2' WHEN 2 THEN 'EMIT' END AS log_sensor FROM (SELECT event_id AS product_id, ts AS acq_time FROM events WHERE event_type <> 'error')""")
def structured_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and fields of product names."""
    i, t = F.col("product_id"), F.date_format("acq_time", "yyyyMMdd'T'HHmmss")
    orbit = F.lpad((i % 100000).cast("string"), 5, "0")
    swath = F.concat(F.lit("S5P_OFFL_L2__CH4____"), t, F.lit("_"), t, F.lit("_"), orbit, F.lit("_03_020400_x.nc"))
    s5p = F.when(i % 3 == 0, swath).otherwise("S5P_plain")
    emit = F.when(i % 2 == 0, F.concat(F.lit("EMIT_x_"), F.lpad(i.cast("string"), 7, "0"), F.lit("_a.nc"))).otherwise(F.concat(F.lit("x"), i.cast("string")))
    plume = F.concat(F.lit("ang"), F.lower(t), F.lit("-AB"))
    log = F.element_at(F.array(F.lit("s5p.log"), F.lit("pull_S2.txt"), F.lit("emit-1"), F.lit("other")), (i % 4 + 1).cast("int"))
    return products(spark, sf_dir).select("product_id", names.overpass_s5p(s5p, "acq_time").alias("s5p"), names.overpass_emit(emit).alias("emit"), names.group_id(plume).alias("grp"), names.granule_like(plume).alias("granule"), names.swath_fields(swath)["orbit"].alias("orbit"), names.sensor_of_log(log).alias("log_sensor"))


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(NULL AS DOUBLE) AS cloud, o_orderstatus AS status FROM orders""")
def aligned_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns found by candidate names, brought to a given form."""
    o = table(spark, sf_dir, "orders")
    found = clean.pick_column(o, ["state", "O_ORDERSTATUS"], ignore_case=True)
    return clean.align(o.withColumnRenamed(found, "status"), {"o_orderkey": "long", "o_custkey": "string", "cloud": "double", "status": "string"})


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, CAST(o_custkey AS INT) AS x, CASE o_orderkey % 4 WHEN 0 THEN 'OFFL' WHEN 3 THEN NULL ELSE 'mixed' END AS level FROM orders WHERE o_orderkey % 5 > 0""")
def indexed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index columns by patterns on a path, the processing level that paths share, rows that have a path."""
    k = F.col("o_orderkey")
    path = F.when(k % 5 > 0, F.concat(F.lit("/data/"), F.date_format("o_orderdate", "yyyy"), F.lit("/pos_"), F.col("o_custkey").cast("string"), F.lit("_7/a.npz"))).when(k % 2 == 0, "  ")
    rows = table(spark, sf_dir, "orders").withColumn("path", path).where(clean.has_text("path"))
    levels = [F.element_at(F.array(*[F.lit(x) for x in own]), (k % 4 + 1).cast("int")) for own in (("a/OFFL/x", "a/OFFL/x", "a/RPRO/x", "x"), ("OFFL", "NRTI", "OFFL", "y"))]
    return rows.select("o_orderkey", *names.path_columns("path", {"year": (r"^/data/(\d{4})/", "string"), "x": (r"/(?:pos|neg)_(-?\d+)_", "int")}), names.level_mix(*levels).alias("level"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sample_id FROM lineitem""")
def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that go on after the greatest one given before."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return windows.numbered(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], after=1000).drop("l_suppkey")


@query("""SELECT user_id, arg_min(event_id, event_id) AS first_id, arg_max(event_id, event_id) AS last_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1""")
def ends_of_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's first and last row in input order, within a range of times."""
    e = table(spark, sf_dir, "events").where(temporal.in_range("ts", "2024-01-05", "2024-01-25"))
    first, last = (windows.one_per_key(e.select("user_id", F.col("event_id").alias(n)), ["user_id"], [o]) for n, o in (("first_id", F.col("first_id")), ("last_id", F.col("last_id").desc())))
    return first.join(last, "user_id")


@query("""WITH x AS (SELECT o_orderkey, row_number() OVER (ORDER BY list_position(['P', 'F'], o_orderstatus) NULLS LAST, o_totalprice DESC, o_orderkey) AS place FROM orders) SELECT * FROM x WHERE place <= 50""")
def listed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order by a list of values, the first 50 of it."""
    o = windows.ordered_by_list(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderstatus", ["P", "F"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).limit(50)
    rank = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "F", 2)
    return windows.rank_rows(o, [], [rank.asc_nulls_last(), F.col("o_totalprice").desc(), F.col("o_orderkey")], "place").select("o_orderkey", F.col("place").cast("long").alias("place"))


@query("""SELECT l_orderkey, l_returnflag AS sensor, CAST(l_linenumber AS VARCHAR) AS path, 'A+N+R' AS combo FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 3) QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) = 1""")
def sensor_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per sensor with the label of all sensors that the event has."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("sensor"), F.col("l_linenumber").cast("string").alias("path"), F.col("l_linenumber").alias("place"))
    wide = master.long_to_wide(rows, ["l_orderkey"], "sensor", ["A", "N", "R"], ["path"], "place")
    some = master.with_any(wide, ["A_path", "N_path", "R_path"])
    combo = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"{s}_path").isNotNull(), s) for s in "ANR"])), "+")
    long = master.wide_to_long(some.withColumn("combo", combo).where("combo = 'A+N+R'"), ["l_orderkey", "combo"], {(s, "t0"): f"{s}_path" for s in "ANR"})
    return long.select("l_orderkey", "sensor", "path", "combo")


@query("""SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT -1""")
def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, and columns, that one table has and the other lacks."""
    a, b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), "c_name"), table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("k"))
    missing = windows.column_difference(a, b)
    return windows.key_difference(a, b, ["k"]).unionByName(spark.range(1).select(F.lit(-1 if missing == ["c_name"] else -2).alias("k")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN 'S2' ELSE 'EMIT' END AS sensor, CASE WHEN l_linenumber = 1 THEN 't0' ELSE 'prev1' END AS timepoint, l_linestatus AS action FROM lineitem) WHERE sensor = 'S2' AND timepoint = 't0' AND action = 'F' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""")
def selected_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sensor's rows of some actions and timepoints, less the keys that are done or excluded."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "A", "S2").otherwise("EMIT").alias("sensor"), F.when(F.col("l_linenumber") == 1, "t0").otherwise("prev1").alias("timepoint"), F.col("l_linestatus").alias("action"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    return master.not_done(planning.work_rows(rows, "S2", ["F"], ["t0"]), done, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""WITH ROLES SELECT oid, product_id FROM pr, su WHERE sensor = 'S2' AND cloud <= 40 AND abs(olat - (product_id % 180 - 90)) <= 3.505 AND abs(olon - (product_id % 360 - 180)) <= 3.505""")
def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every site's search: products of a type, with little cloud, whose footprint meets the site's box."""
    around = lambda lat, lon, r: geo.box(lon - r, lat - r, lon + r, lat + r)
    i = F.col("product_id")
    found = products(spark, sf_dir).where("sensor = 'S2' and cloud <= 40").select("product_id", around((i % 180 - 90).cast("double"), (i % 360 - 180).cast("double"), 1.5025).alias("footprint"))
    asked = sites(spark, sf_dir).select("oid", around(F.col("olat"), F.col("olon"), 2.0025).alias("asked"))
    return cover.boxes_that_meet(asked, found, "asked", "footprint").select("oid", "product_id")


@query("""WITH d AS (SELECT event_id, CAST(ts AS DATE) + 490 AS day, list_filter([CASE WHEN event_id % 2 = 0 THEN 'S2' END, CASE WHEN event_id % 3 = 0 THEN 'L89' END, CASE WHEN event_id % 5 = 0 THEN 'EMIT' END], lambda x: x IS NOT NULL) AS s FROM events)
SELECT event_id, CASE WHEN len(s) = 0 THEN 'gap' WHEN (list_contains(s, 'S2') AND day >= DATE '2025-05-18') OR (list_contains(s, 'L89') AND day >= DATE '2025-05-11') OR (list_contains(s, 'EMIT') AND day >= DATE '2025-02-12') THEN 'test'
WHEN (list_contains(s, 'S2') AND day <= DATE '2025-05-16') OR (list_contains(s, 'L89') AND day <= DATE '2025-05-10') OR (list_contains(s, 'EMIT') AND day <= DATE '2025-02-11') THEN 'train' ELSE 'gap' END AS split FROM d""")
def temporal_split_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any sensor in test makes test."""
    i = F.col("event_id")
    e = table(spark, sf_dir, "events").select("event_id", F.date_add(F.col("ts").cast("date"), 490).alias("day"), F.array_compact(F.array(*[F.when(i % k == 0, s) for s, k in (("S2", 2), ("L89", 3), ("EMIT", 5))])).alias("have"))
    return splits.temporal_split(e, "day", "have", "loose_test_priority").select("event_id", "split")


@query(f"""WITH s AS (SELECT o_custkey, count(*) AS n, {HASH_SQL.format("o_custkey || ':5'")} AS h FROM orders GROUP BY 1), b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY h, o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total, count(*) OVER () AS sites FROM s)
SELECT o_orderkey, CASE WHEN before < 0.7 * total AND NOT (before + n = total AND sites > 1) THEN 'train' ELSE 'test' END AS split FROM orders JOIN b USING (o_custkey)""")
def seeded_site_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sites in an order by hash, to train until they hold the ratio, some test."""
    return splits.site_split(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", 0.7, seed=5).select("o_orderkey", "split")


@query("""SELECT vec_id AS chip_id, label::INT AS changed, list_count(list_filter(embedding, lambda x: x > 0)) AS positives, round(list_count(list_filter(embedding, lambda x: x > 0)) / 64.0, 6) AS share FROM (SELECT vec_id, embedding, 1 AS label FROM embeddings)""")
def binary_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks made binary, whether that changed any, and their statistics after it."""
    ones = quality.binarised(chips(spark, sf_dir), "px")
    s = chip.mask_stats("px")
    return ones.select("chip_id", (F.col("changed") & s["binary"]).cast("int").alias("changed"), s["positives"].cast("long").alias("positives"), F.round(s["share"], 6).alias("share"))


@query("""SELECT vec_id AS chip_id, CASE WHEN embedding[1] > 0 THEN round(embedding[1]::DOUBLE, 5) END AS corner, list_count(list_filter([embedding[1], embedding[8], embedding[57], embedding[64]], lambda x: x > 0)) AS known FROM embeddings""")
def known_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resize that counts known pixels only; with aligned corners the corners are the corners."""
    c = chips(spark, sf_dir).withColumn("px", F.transform("px", lambda v: F.when(v > 0, v)))
    small = chip.resize_known("px", 8, 8, 2, 2)
    return c.select("chip_id", F.round(small[0], 5).alias("corner"), F.size(F.filter(small, lambda v: v.isNotNull())).cast("long").alias("known"))


@query("""SELECT 'ok' AS verdict, (SELECT count(*) FROM orders) AS n""")
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: a release passes if no rule of severity error finds anything; one that finds something raises."""
    o = table(spark, sf_dir, "orders")
    n, bad = o.agg(F.count("*").alias("n")), o.agg(F.count_if(F.col("o_orderkey").isNull()).alias("k"))
    good = quality.issues([("warning", "rows", n, F.col("n")), ("error", "null_keys", bad, F.when(F.col("k") > 0, F.col("k")))])
    quality.require_none(good)
    try:
        quality.require_none(quality.issues([("error", "rows", n, F.col("n"))]))
    except ValueError:
        return n.select(F.lit("ok").alias("verdict"), "n")
    return n.select(F.lit("not raised").alias("verdict"), "n")


@query("""SELECT l_orderkey AS event_id, l_linenumber AS timepoint, CASE WHEN l_quantity > 10 THEN CAST(l_partkey AS VARCHAR) END AS path FROM lineitem WHERE l_returnflag = 'R'""")
def mapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted records as updates; spelled-out nulls are null."""
    rows = table(spark, sf_dir, "lineitem").withColumn("text", F.when(F.col("l_quantity") > 10, F.col("l_partkey").cast("string")).otherwise(" None "))
    return state.mapped_updates(rows, {"event_id": F.col("l_orderkey"), "timepoint": F.col("l_linenumber"), "path": "text"}, F.col("l_returnflag") == "R")


@query("""WITH f AS (SELECT user_id, CAST(ts AS DATE) AS d, min(event_id) AS asked FROM events GROUP BY 1, 2) SELECT event_id, asked FROM events JOIN f ON events.user_id = f.user_id AND CAST(ts AS DATE) = d""")
def cached_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search for each user and day; its answer goes to all requests of the group."""
    requests = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    asked, back = state.through_cache(requests, ["user_id", "day"], "event_id")
    return back.join(asked.select("user_id", "day", F.col("event_id").alias("asked")), ["user_id", "day"]).select("event_id", "asked")


@query("""SELECT max(o_orderkey) AS last_row, max(o_custkey) AS last_id, CAST(-1 AS BIGINT) AS none_row, CAST(0 AS BIGINT) AS none_id FROM orders""")
def resume_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the output goes, and for none."""
    o = table(spark, sf_dir, "orders")
    none = state.resume_point(o.where("o_orderkey < 0"), "o_orderkey", "o_custkey").select(F.col("last_row").alias("none_row"), F.col("last_id").alias("none_id"))
    return state.resume_point(o, "o_orderkey", "o_custkey").crossJoin(none)


@query("""SELECT CAST(s_suppkey AS BIGINT) AS supplier, CAST(i AS INT) AS band, 2 AS height, 3 AS width, CAST(s_nationkey + i * 6 + 5 AS DOUBLE) AS last FROM supplier, (SELECT unnest([0, 1]) AS i)""")
def array_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: array files, as readers of binary files give them, to a row for each band; the arrays are made of the table in tasks."""
    def payload(batches):
        import io

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = []
            for supplier, nation in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = io.BytesIO()
                np.savez(out, arr_0=np.arange(12, dtype=np.float32).reshape(2, 2, 3) + nation)
                rows.append((str(supplier), out.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["path", "content"])

    files = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").mapInArrow(payload, "path string, content binary")
    return scans.chips_of_arrays(files).select(F.col("path").cast("long").alias("supplier"), "band", "height", "width", F.element_at("px", -1).cast("double").alias("last"))
