"""Registered queries, each with the SQL that gives the same rows where there is one; the roles tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Common table expressions that the SQL of queries starts with: the roles of the tables.
ROLES = """
er AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error'),
pr AS (SELECT event_id AS product_id, user_id, ts AS acq_time, value AS cloud, user_id || '_' || CAST(floor(epoch_us(ts) / 600000000) AS BIGINT) AS overpass,
  CASE event_type WHEN 'view' THEN 'S2' WHEN 'click' THEN 'L89' WHEN 'purchase' THEN 'EMIT' ELSE 'S5P' END AS sensor FROM events WHERE event_type <> 'error'),
cu AS (SELECT c_custkey AS pid, ((c_custkey * 7919) % 18000) / 100.0 - 90 AS lat, ((c_custkey * 104729) % 36000) / 100.0 - 180 AS lon, c_nationkey AS nation, c_acctbal AS bal FROM customer),
su AS (SELECT s_suppkey AS oid, ((s_suppkey * 7919) % 18000) / 100.0 - 90 AS olat, ((s_suppkey * 104729) % 36000) / 100.0 - 180 AS olon, s_acctbal AS qa FROM supplier)
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql.replace("WITH ROLES", "WITH " + ROLES.strip())
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; zone-less times become timestamps (the session's zone is UTC)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(n).cast("timestamp").alias(n) if t == "timestamp_ntz" else F.col(n) for n, t in df.dtypes])


def sensor_of(kind: str = "event_type") -> Column:
    return F.when(F.col(kind) == "view", "S2").when(F.col(kind) == "click", "L89").when(F.col(kind) == "purchase", "EMIT").otherwise("S5P")


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event catalogue."""
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", "ts", "value")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product catalogue."""
    slot = F.floor(F.unix_micros("ts") / 600_000_000).cast("long").cast("string")
    return table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.col("event_id").alias("product_id"), "user_id", F.col("ts").alias("acq_time"), F.col("value").alias("cloud"), F.concat_ws("_", F.col("user_id").cast("string"), slot).alias("overpass"), sensor_of().alias("sensor"))


def _place(key: str, lat: str, lon: str) -> list[Column]:
    return [(((F.col(key) * 7919) % 18000) / 100.0 - 90).alias(lat), (((F.col(key) * 104729) % 36000) / 100.0 - 180).alias(lon)]


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pid"), *_place("c_custkey", "lat", "lon"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("oid"), *_place("s_suppkey", "olat", "olon"), F.col("s_acctbal").alias("qa"))


def chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 chips of one band."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chip_id"), F.lit(0).alias("band"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.transform("embedding", lambda x: x.cast("double")).alias("px"), "label")


def us(c: str) -> Column:
    return F.unix_micros(c)


def day_text(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
