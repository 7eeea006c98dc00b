"""Reading manifests (CSV, every field text), catalogues, metadata files, inventories, chips."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.functions.clean import sensor_list
from eventloom.operators.windows import one_per_key


def manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A CSV with header, all text; quotes doubled, a byte-order mark skipped, line breaks in fields kept."""
    return spark.read.csv(path if isinstance(path, str) else list(path), header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")


def with_sequence(df: DataFrame) -> DataFrame:
    """Adds `seq`, which orders rows as files and lines do: file path, then place in the file.

    Only valid straight after the scan of files that are read in one piece."""
    return df.withColumn("seq", F.struct(F.input_file_name(), F.monotonically_increasing_id()))


def projected(df: DataFrame, columns: Sequence[str], rename: Mapping[str, str], key: str, order: Sequence[str]) -> DataFrame:
    """The wanted columns that there are, renamed, one row a key."""
    kept = df.select(*[c for c in columns if c in df.columns], *[c for c in order if c not in columns])
    return one_per_key(kept, [key], order).select(*[c for c in columns if c in df.columns]).withColumnsRenamed(dict(rename))


def lookup_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A look-up table; an absent file gives an empty one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    names = [x.split()[0] for x in schema.split(",")]
    found = manifest(spark, path)
    return found.select(*[F.col(n) if n in found.columns else F.lit(None).cast("string").alias(n) for n in names])


def catalogue(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Manifests of different headers, one below the other."""
    out = None
    for p in paths:
        part = manifest(spark, p)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of files below a path; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def older_than(files: DataFrame, seconds: float, now: Column | None = None) -> DataFrame:
    """files not touched for the seconds; `now` can be given."""
    return files.where(F.unix_micros("modified") < F.unix_micros(F.current_timestamp() if now is None else now) - int(seconds * 1e6))


def folders_to_manifest(files: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Sample folders named pos_X_Y or neg_X_Y with all needed files: label, x, y, folder."""
    rows = files.select(F.regexp_extract("path", r"^(.*)/([^/]+)$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"))
    sets = rows.groupBy("folder").agg(F.collect_set("file").alias("files"))
    whole = sets.where(F.size(F.array_except(F.array(*[F.lit(n) for n in needed]), "files")) == 0)
    name = F.regexp_extract("folder", r"([^/]+)$", 1)
    at = lambda g: F.regexp_extract(name, r"^(pos|neg)_(-?\d+)_(-?\d+)", g)
    return whole.where(name.rlike(r"^(pos|neg)_-?\d+_-?\d+")).select("folder", F.when(at(1) == "pos", 1).otherwise(0).alias("label"), at(2).cast("int").alias("x"), at(3).cast("int").alias("y"))


# Schemes, scales (metres) and splits that a release has.
SCHEMES, SCALES, SPLITS = ("temporal", "geographic"), (120, 360, 480, 960), ("train", "test")


def released_split(df: DataFrame, scheme: str, scale: int | str, split: str) -> DataFrame:
    """One split of a release partitioned by scheme, scale and split; unknown values raise at once."""
    metres = int(str(scale).lower().removesuffix("m"))
    for value, allowed, what in ((scheme, SCHEMES, "scheme"), (metres, SCALES, "scale"), (split, SPLITS, "split")):
        if value not in allowed:
            raise ValueError(f"{what} {value!r} is none of {allowed}")
    return df.where((F.col("scheme") == scheme) & (F.col("scale") == metres) & (F.col("split") == split))


def member_index(members: DataFrame) -> DataFrame:
    """Each member's archive, the first by name: from (archive, member)."""
    return members.groupBy("member").agg(F.min("archive").alias("archive"))


def samples(df: DataFrame, requested: Sequence[str], available: str, paths: Mapping[str, Mapping[str, str]], label: str = "label") -> DataFrame:
    """Per row the sensors both available and asked for, with their non-empty paths by role."""
    sensors = F.array_intersect(sensor_list(available), F.array(*[F.lit(s) for s in requested]))
    role_map = lambda roles: F.map_filter(F.create_map(*[x for r, c in roles.items() for x in (F.lit(r), F.col(c))]), lambda _, v: v.isNotNull() & (F.trim(v) != ""))
    every = F.create_map(*[x for s, roles in paths.items() for x in (F.lit(s), role_map(roles))])
    return df.withColumn("sensors", sensors).withColumn("sensor_paths", F.map_filter(every, lambda k, _: F.array_contains(F.col("sensors"), k))).withColumn(label, F.col(label).try_cast("int"))


def chips_of_arrays(files: DataFrame, array: str = "arr_0") -> DataFrame:
    """A10: .npz payloads (binaryFile rows) to chip rows (path, band, height, width, px), bands first.

    The archive format is read by numpy inside Arrow batches; one payload is in memory at a time.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import numpy as np

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with np.load(io.BytesIO(content.as_py())) as z:
                    a = np.asarray(z[array if array in z.files else z.files[0]], dtype=np.float32)
                if a.ndim == 2:
                    a = a[None]
                elif a.shape[-1] < min(a.shape[0], a.shape[1]):  # bands last
                    a = np.moveaxis(a, -1, 0)
                n, h, w = a.shape
                px = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (h * w)), pa.array(a.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array(range(n), pa.int32()), pa.array([h] * n, pa.int32()), pa.array([w] * n, pa.int32()), px], ["path", "band", "height", "width", "px"])

    return files.select("path", "content").mapInArrow(read, "path string, band int, height int, width int, px array<float>")


def xml_metadata(df: DataFrame, xml: str, fields: Mapping[str, str]) -> DataFrame:
    """XPath fields of XML documents in a column."""
    return df.select("*", *[F.xpath_string(xml, F.lit(path)).alias(n) for n, path in fields.items()])


def footprint_of(c: Column | str) -> Column:
    """A11: 'lat lon lat lon ...' to an array of (lat, lon)."""
    v = F.split(F.trim(F.col(c) if isinstance(c, str) else c), r"\s+")
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / 2).cast("int") - 1), lambda i: F.struct(v[2 * i].try_cast("double").alias("lat"), v[2 * i + 1].try_cast("double").alias("lon")))


def key_values(lines: DataFrame, file: str, text: str, keys: Sequence[str]) -> DataFrame:
    """KEY = VALUE lines to one row a file with the given keys; quotes go."""
    key, value = F.trim(F.split_part(text, F.lit("="), F.lit(1))), F.trim(F.regexp_replace(F.trim(F.regexp_extract(text, r"=(.*)$", 1)), '^"|"$', ""))
    rows = lines.select(file, key.alias("_k"), value.alias("_v")).where(F.col("_k").isin(*keys))
    return rows.groupBy(file).agg(*[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(k) for k in keys])


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("text"))
