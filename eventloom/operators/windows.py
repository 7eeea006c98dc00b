"""Ranking per key, ordered cuts, samples and set operations by row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from eventloom.functions.clean import row_signature

Order = Sequence[Column | str]


def rank_rows(df: DataFrame, keys: Sequence[str], order: Order, name: str = "rank") -> DataFrame:
    """Adds a rank from 1 within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Each key's first row in an explicit order (last: pass descending columns)."""
    return rank_rows(df, keys, order, "_rank").where("_rank = 1").drop("_rank")


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Order, n: int | Column, valid: Column | None = None) -> DataFrame:
    """The first n rows of each key that pass `valid`."""
    rows = df if valid is None else df.where(valid)
    return rank_rows(rows, keys, order, "_rank").where(F.col("_rank") <= n).drop("_rank")


def farthest(df: DataFrame, keys: Sequence[str], distance: Column, tie: str) -> DataFrame:
    """Each key's row of greatest distance, ties to the least `tie`."""
    return one_per_key(df, keys, [distance.desc(), F.col(tie)])


def top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    """The first k rows; each task keeps k, one task merges."""
    return df.orderBy(*order).limit(k)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """An order that only key and seed decide."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)


def ordered_by_list(df: DataFrame, column: str, values: Sequence[str], then: Order = ()) -> DataFrame:
    """Sorts by the place of a value in a list, unknown ones last."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return df.orderBy(F.when(place > 0, place).asc_nulls_last(), *then)


def examples(df: DataFrame, column: str, keys: Sequence[str] = (), n: int = 20) -> DataFrame:
    """Up to n least distinct values of each key, and how many there are.

    Values are ranked per key after a distinct, so no list grows beyond n.
    """
    values = df.select(*keys, column).where(F.col(column).isNotNull()).distinct()
    grouped = values.groupBy(*keys).agg(F.count("*").alias("n_values")) if keys else values.agg(F.count("*").alias("n_values"))
    kept = first_n_per_key(values, keys, [column], n) if keys else values.orderBy(column).limit(n)
    lists = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(column)).alias("examples"))
    return grouped.join(lists, list(keys)) if keys else grouped.crossJoin(lists)  # one row each


def append_new(existing: DataFrame, more: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Existing rows, then those of `more` whose fields' signature is new; of equal new ones one."""
    seen = existing.select(row_signature(fields).alias("_s")).distinct()
    fresh = more.withColumn("_s", row_signature(fields)).dropDuplicates(["_s"]).join(seen, "_s", "left_anti").drop("_s")
    return existing.unionByName(fresh, allowMissingColumns=True)


def union_named(tables: dict[str, tuple[DataFrame, dict[str, str]]], name: str = "sensor") -> DataFrame:
    """Tables with their columns renamed and a literal of their name, one below the other."""
    out = None
    for value, (df, renames) in tables.items():
        part = df.withColumnsRenamed(renames).withColumn(name, F.lit(value))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


#: Rows of the sample for each range of `range_bucket`.
SAMPLED = 50


def range_bucket(df: DataFrame, order: Sequence[str], name: str = "_bucket") -> DataFrame:
    """Adds the number of the row's range in the order of some columns (ascending, nulls first); ranges hold about equal
    counts, those of one repeated value too if a later column tells its rows apart.

    The borders, as many as shuffle partitions, are taken from a sample that a hash of the columns decides; a row
    finds its range by binary search.  `df` is read three times, so write it first where it is dear.
    """
    spark, n = df.sparkSession, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    share = max(1, df.count() // (SAMPLED * n))
    sample = df.select(key.alias("k")).where(F.pmod(F.xxhash64("k"), F.lit(share)) == 0).distinct().orderBy("k").collect()
    borders = [sample[i * len(sample) // n].k for i in range(1, n)] if sample else []
    kind = df.select(F.array(key).alias("_borders")).schema
    one = spark.createDataFrame([(list(dict.fromkeys(borders)),)], StructType([StructField("_borders", kind["_borders"].dataType)]))
    rounds = max(1, n.bit_length())

    def step(state: Column, _: Column) -> Column:
        middle = ((state["lo"] + state["hi"]) / 2).cast("int")
        over = F.get(F.col("_borders"), middle) <= key
        narrowed = F.struct(F.when(over, middle + 1).otherwise(state["lo"]).alias("lo"), F.when(over, state["hi"]).otherwise(middle).alias("hi"))
        return F.when(state["lo"] < state["hi"], narrowed).otherwise(state)

    found = F.aggregate(F.sequence(F.lit(0), F.lit(rounds)), F.struct(F.lit(0).alias("lo"), F.size("_borders").alias("hi")), step)
    return df.crossJoin(F.broadcast(one)).withColumn(name, found["lo"]).drop("_borders")  # one row


def running_total(df: DataFrame, weight: str, column: str, ties: Sequence[str], name: str = "before") -> DataFrame:
    """The sum of `weight` over the rows before, in the order (column, ties), with no global sort in
    one task: ranges sum in parallel, and only the ranges' totals meet."""
    rows = range_bucket(df, [column, *ties])
    sums = rows.groupBy("_bucket").agg(F.sum(weight).alias("_w"))
    start = sums.select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_w").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = F.coalesce(F.sum(weight).over(Window.partitionBy("_bucket").orderBy(column, *ties).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_in", inside).join(F.broadcast(start), F.col("_bucket") == F.col("_b")).withColumn(name, F.col("_start") + F.col("_in")).drop("_bucket", "_b", "_start", "_in")


def nearest_value(df: DataFrame, column: str, values: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the nearest of a column of values, ties to the lower; null where either side has none.

    Rows and distinct values meet in one order, cut into ranges; each row looks at the last value before it and the
    next after it in its range, and at what the ranges around end with, a table of one row a range.  So the values
    may be as many as they like, and a value that very many rows have is split.
    """
    own = df.select(F.col(column).cast("double").alias("_v"), F.lit(1).alias("_kind"), F.xxhash64(*df.columns).alias("_tie"), F.struct(*df.columns).alias("_row"))
    axis = values.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).distinct()
    both = own.unionByName(axis.select("_v", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.lit(None).cast(df.schema).alias("_row")))
    rows = range_bucket(both, ["_v", "_kind", "_tie"]).withColumn("_a", F.when(F.col("_kind") == 0, F.col("_v")))
    inside = Window.partitionBy("_bucket").orderBy("_v", "_kind", "_tie")
    near = rows.withColumn("_lower", F.last("_a", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_upper", F.first("_a", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing)))
    ends = rows.groupBy("_bucket").agg(F.min("_a").alias("_low"), F.max("_a").alias("_high"))
    along = Window.orderBy("_bucket")
    ends = ends.select(F.col("_bucket").alias("_b"), F.last("_high", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_below"), F.first("_low", ignorenulls=True).over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_above"))
    joined = near.where("_kind = 1").join(F.broadcast(ends), F.col("_bucket") == F.col("_b"))
    lower, upper = F.coalesce("_lower", "_below"), F.coalesce("_upper", "_above")
    best = F.when(F.col("_v").isNotNull(), F.when(upper.isNull() | (F.col("_v") - lower <= upper - F.col("_v")), lower).otherwise(upper))
    return joined.select("_row.*", best.alias(name))


def numbered(df: DataFrame, column: str, ties: Sequence[str], after: int = 0, name: str = "sample_id") -> DataFrame:
    """Consecutive ids from after + 1 in the order (column, ties), gapless across tasks: ranges count in
    parallel, and only their totals meet.  `after` is the greatest id given before."""
    return running_total(df.withColumn("_one", F.lit(1)), "_one", column, ties, "_place").withColumn(name, (F.col("_place") + after + 1).cast("long")).drop("_one", "_place")


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of `a` that `b` lacks (null equals null)."""
    return a.select(*keys).subtract(b.select(*keys))


def column_difference(a: DataFrame, b: DataFrame) -> list[str]:
    """The columns of `a` that `b` lacks, in order."""
    return [c for c in a.columns if c not in b.columns]
