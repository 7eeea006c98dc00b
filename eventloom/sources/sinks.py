"""Writing manifests, splits and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def manifest_form(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The fields in order as text; unknown columns go, absent ones and nulls are blank."""
    return df.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in df.columns else F.lit("").alias(f) for f in fields])


def write_manifest(df: DataFrame, path: str, fields: Sequence[str], append: bool = False) -> None:
    """As CSV parts with headers."""
    manifest_form(df, fields).write.mode("append" if append else "errorifexists").csv(path, header=True, escape='"')


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """A folder for each split; rows without one are `unassigned`."""
    df.withColumn(split, F.coalesce(split, F.lit("unassigned"))).write.partitionBy(split).parquet(path)


def write_report(document: DataFrame, path: str) -> None:
    """JSON documents (manifest, document), one line each."""
    document.orderBy("manifest").select("document").write.text(path)

