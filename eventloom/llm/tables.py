"""Reading the tables, joins on frequent keys, gapless ranks; scratch tables come from `eventloom.scratch`."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from eventloom.scratch import Scratch, setting, shared_folder

__all__ = ["FREQUENT", "Scratch", "fields", "gapless_rank", "join_frequent", "partitions", "read", "setting", "shared_folder", "short_batches", "with_lists"]

#: Keys that more than one in so many rows have are joined by broadcast: there can't be more of them than this.
FREQUENT = 5_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = 2000):
    """While inside, fewer rows go to a Python worker at once: texts are long, and a worker holds a batch two
    or three times over."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_frequent(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], often: str) -> DataFrame:
    """The inner join of `rows` with `keyed` (written tables), whose keys are distinct (null equals null);
    `often` is a column of `keyed` with how many rows have the key.  Rows of keys that more than one row in
    FREQUENT has stay where they are: those keys are few by arithmetic and are broadcast.  Others meet in a shuffle."""
    total = keyed.agg(F.sum(often)).first()[0] or 0
    frequent = F.col(often) * FREQUENT > total
    keyed = keyed.withColumnsRenamed({k: f"__{k}" for k in keys})
    hot, cold, own = keyed.where(frequent).drop(often), keyed.where(~frequent).drop(often), [f"__{k}" for k in keys]
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    stay = rows.join(F.broadcast(hot), same).drop(*own)
    return stay.unionByName(rows.join(F.broadcast(hot.select(*own)), same, "left_anti").join(cold, same).drop(*own))


def fields(df: DataFrame) -> str:
    """The columns with their types, as functions on Arrow batches want them."""
    return ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)


def with_lists(df: DataFrame, on: dict[str, Column], lists: DataFrame) -> DataFrame:
    """(the row as one struct, what `lists` (the columns of `on`, and another) has for it or null): whatever the
    columns of `df` are called, none clashes.  Rows and lists meet in a sort-merge join at every size, so that what a
    small table shows of its cost holds for a large one, whose lists are too many to be broadcast."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(f"{n}_") for n, c in on.items()])
    same = [F.col(f"{n}_") == F.col(n) for n in on]
    return rows.join(lists.hint("merge"), functools.reduce(operator.and_, same), "left").select("_row", *[c for c in lists.columns if c not in on])


def gapless_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds `name`: 0, 1, 2 ... within the rows of equal `keys`, with no key's rows in one task.

    Rows go to (key, slice of a hash of `order`), are numbered in each slice, and get the sum of the
    earlier slices' counts, a table of keys x slices.  The rank follows (slice, order), the same at
    every run; rows equal in all of `order` are interchangeable.  `df` is read twice, so write it first.
    Column names that begin with two underscores are the rank's own.
    """
    n = partitions(df.sparkSession)
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = sliced.groupBy(*keys, "__slice").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__slice").alias("__s"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(*order)).cast("long") - 1
    on = F.col("__slice") == F.col("__s")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    ranked = sliced.withColumn("__in", inside).join(counts, on).withColumn(name, F.col("__before") + F.col("__in"))
    return ranked.drop("__slice", "__s", "__in", "__before", *[f"__{k}" for k in keys])
