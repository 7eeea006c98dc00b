"""Queries of the streaming jobs: tables written as files, read as streams, results read back from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventloom.operators import manifest, master
from eventloom.plans.registry import query, table
from eventloom.scratch import Scratch
from eventloom.streaming import jobs


def _arriving(spark: SparkSession, rows: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """The rows as files that a stream takes one by one, in the order of `ts`; those of `last` come after all others."""
    path = Scratch(spark).path()
    rows.repartitionByRange(4, "ts").write.parquet(path)
    if last is not None:
        last.write.mode("append").parquet(path)
    return jobs.new_files(spark, path, rows.schema.simpleString()[7:-1].replace(":", " "), files_per_batch=2)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def streamed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files of events, counted in windows of a day; the last count of each window stands."""
    counts = jobs.status_counts(_arriving(spark, _events(spark, sf_dir)), "ts", "event_type", "60 days", "1 day")
    out = jobs.updates_to_files(counts, Scratch(spark).path())
    return out.groupBy(F.col("window.start").alias("start"), "event_type").agg(F.max("n").alias("n")).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("""WITH u AS (SELECT o_custkey, arg_max(CAST(o_orderkey AS VARCHAR), o_orderkey) FILTER (o_orderstatus <> 'P') AS path, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1) SELECT c_custkey, coalesce(u.path, CASE c_custkey % 4 WHEN 0 THEN 'kept' WHEN 1 THEN 'later' END) AS path, coalesce(status, 'new') AS status FROM customer LEFT JOIN u ON c_custkey = o_custkey""")
def streamed_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's updates to the newest of a manifest's versions; those without a path change the status alone."""
    root, mark = Scratch(spark).path(), Scratch(spark).path()
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lit(None).cast("string").alias("path"), F.lit("new").alias("status"))
    manifest.create(rows, root, ["c_custkey"], 16)
    for part, value in ((0, "kept"), (1, "later")):  # earlier versions, by other writers
        more = rows.where(F.col("c_custkey") % 4 == part).select("c_custkey", F.lit(value).alias("path"), F.lit(1).alias("seq"))
        manifest.upsert(root, more, "seq", "path", ["path"])
    updates = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("path"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("seq"), F.timestamp_seconds("o_orderkey").alias("ts"))
    newest = updates.groupBy("c_custkey").agg(F.max_by("path", F.when(F.col("path").isNotNull(), F.col("seq"))).alias("path"), F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"), F.max("ts").alias("ts"))
    arriving = _arriving(spark, newest)
    for _ in range(2):  # the second run finds nothing new
        jobs.upsert_stream(arriving, root, "seq", "path", ["path"], mark, provenance=["status"])
    return manifest.read(spark, root)


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def streamed_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first row of a type within the delay, once, whatever arrives again."""
    twice = _events(spark, sf_dir).unionByName(_events(spark, sf_dir))
    once = jobs.usage_once(_arriving(spark, twice), "ts", "400 days", ["user_id", "event_type"])
    return jobs.updates_to_files(once.select("user_id", "event_type"), Scratch(spark).path(), "append")


@query("""WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS event, CASE l_linenumber WHEN 1 THEN 't0' ELSE 'p' || l_linenumber END AS timepoint, l_quantity > 20 AS ok FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) = 1) WHERE l_linenumber > 1 OR l_orderkey % 5 > 0), t AS (SELECT event, ok FROM r WHERE timepoint = 't0')
SELECT event, timepoint, CASE WHEN timepoint = 't0' THEN CASE WHEN r.ok THEN 't0_ok' ELSE 't0_failed' END WHEN t.ok THEN 'proceed' ELSE 'skip_t0_failed' END AS gate FROM r LEFT JOIN t USING (event)""")
def streamed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other timepoints wait for their event's t0, which comes in any order or, for a fifth of the events and
    more, never: then they are skipped when their time is up, as the last row's time shows."""
    from eventloom.operators.windows import one_per_key

    rows = one_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"]).where("l_linenumber > 1 or l_orderkey % 5 > 0")
    gated = rows.select(F.col("l_orderkey").cast("string").alias("event"), F.when(F.col("l_linenumber") == 1, "t0").otherwise(F.concat(F.lit("p"), F.col("l_linenumber").cast("string"))).alias("timepoint"), (F.col("l_quantity") > 20).alias("ok"), F.timestamp_seconds(F.lit(1_700_000_000) - F.col("l_linenumber")).alias("ts"))
    last = spark.range(1).select(F.lit("clock").alias("event"), F.lit("t0").alias("timepoint"), F.lit(True).alias("ok"), F.timestamp_seconds(F.lit(1_701_000_000)).alias("ts"))
    out = jobs.updates_to_files(jobs.t0_gate_stream(_arriving(spark, gated, last), "event", "ts", "1 day", 86_400_000), Scratch(spark).path(), "append")
    return out.where("event <> 'clock'")


@query("""SELECT e.event_id, p.event_id AS product_id FROM events e JOIN events p ON e.user_id = p.user_id AND e.event_type = 'error' AND p.event_type = 'view' AND abs(epoch_us(e.ts) - epoch_us(p.ts)) <= 7200000000""")
def streamed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and products of a user within two hours of each other, as both arrive."""
    e = _arriving(spark, _events(spark, sf_dir).where("event_type = 'error'").select("event_id", "user_id", "ts"))
    p = _arriving(spark, _events(spark, sf_dir).where("event_type = 'view'").select(F.col("event_id").alias("product_id"), "user_id", "ts")).withColumnRenamed("ts", "acq")
    pairs = jobs.match_streams(e, p, "user_id", "ts", "acq", "2 hours", "60 days")
    return jobs.updates_to_files(pairs.select("event_id", "product_id"), Scratch(spark).path(), "append")


@query("""SELECT event_id FROM events""")
def streamed_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run goes on from the checkpoint, once the manifest is known to be the same but for what was
    appended; files that came before it are not taken again."""
    path, out, mark = (Scratch(spark).path() for _ in range(3))
    e = _events(spark, sf_dir)
    middle = e.agg(F.expr("percentile_disc(0.5) within group (order by event_id)")).first()[0]
    first = e.where(F.col("event_id") <= middle)
    for half, whole in ((first, first), (master.not_done(e, first, ["event_id"]), e)):
        half.write.mode("append").parquet(path)
        rows = jobs.new_files(spark, path, "event_id long, user_id long, ts timestamp, event_type string, value double")
        jobs.run_guarded(rows.select("event_id").writeStream.format("parquet").option("path", out), mark, whole, "event_id")
    return spark.read.parquet(out)
