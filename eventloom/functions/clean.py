"""Loosely typed manifest text to nulls, booleans, numbers and tokens. Columns in, columns out; no UDFs."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The null spellings of each manifest family (after trimming, any case).
NULL_TOKENS: dict[str, tuple[str, ...]] = {
    "report": ("", "nan", "none", "null"),
    "query": ("", "nan", "none"),
    "path": ("", "nan"),
    "manifest": ("", "nan", "none", "null", "<na>"),
    "planner": ("", "nan", "none", "<na>"),
}
# Spellings of true.
TRUE_TOKENS: dict[str, tuple[str, ...]] = {"plain": ("true", "1", "yes"), "short": ("true", "1", "yes", "t", "y")}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    return F.trim(_col(c).cast("string"))


def null_if_sentinel(c: Column | str, profile: str = "report") -> Column:
    """The trimmed text, null for a null spelling of the profile."""
    t = trimmed(c)
    return F.when(~F.lower(t).isin(*NULL_TOKENS[profile]), t)


def has_value(c: Column | str, profile: str = "report") -> Column:
    """P01 as a test, never null."""
    return null_if_sentinel(c, profile).isNotNull()


def clean_text(c: Column | str, profile: str = "query") -> Column:
    """Null spellings become empty text."""
    return F.coalesce(null_if_sentinel(c, profile), F.lit(""))


def text_bool(c: Column | str, vocabulary: str = "plain") -> Column:
    """Whether the text spells true; null counts as false."""
    return F.coalesce(F.lower(trimmed(c)).isin(*TRUE_TOKENS[vocabulary]), F.lit(False))


def safe_double(c: Column | str) -> Column:
    """The number in the text; null where there is none or it is NaN."""
    x = trimmed(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def number_flaw(c: Column | str, profile: str = "report") -> Column:
    """P04: 'missing', 'invalid' or null where the text is a number."""
    return F.when(~has_value(c, profile), "missing").when(safe_double(c).isNull(), "invalid")


def first_value(columns: Sequence[Column | str], profile: str = "manifest") -> Column:
    """The first of several aliases that has a value."""
    return F.coalesce(*[null_if_sentinel(c, profile) for c in columns])


def pick_column(df: DataFrame, candidates: Iterable[str], ignore_case: bool = False) -> str | None:
    """The first candidate name that the frame has."""
    if not ignore_case:
        return next((c for c in candidates if c in df.columns), None)
    by_lower = {c.lower(): c for c in reversed(df.columns)}
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def align(df: DataFrame, fields: Mapping[str, str], keep_extra: bool = False) -> DataFrame:
    """The given columns in the given order and types; absent ones are null, others go (or follow)."""
    have = [F.col(n).try_cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in fields.items()]
    return df.select(*have, *([c for c in df.columns if c not in fields] if keep_extra else []))


# Sensors, and spellings that stand for them (upper case, letters and digits only).
SENSORS = ("S2", "L89", "EMIT", "S5P")
SENSOR_ALIASES = {"S2": "S2", "SENTINEL2": "S2", "L8": "L89", "L9": "L89", "L89": "L89", "LANDSAT": "L89", "LANDSAT8": "L89", "LANDSAT9": "L89", "EMIT": "EMIT", "S5P": "S5P", "SENTINEL5P": "S5P"}


def sensor_name(c: Column | str) -> Column:
    """A sensor token's usual spelling, null for an unknown one."""
    key = F.regexp_replace(F.upper(_col(c)), "[^A-Z0-9]", "")
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SENSOR_ALIASES.items() for x in kv]), key)


def sensor_list(c: Column | str) -> Column:
    """Distinct known sensors of a token list, sorted."""
    tokens = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit("[A-Za-z0-9_-]+"), F.lit(0))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(tokens, sensor_name))))


def sensors_or_paths(c: Column | str, paths: Mapping[str, Sequence[str]]) -> Column:
    """The listed sensors; where none is listed, those with any path."""
    found = F.array_compact(F.array(*[F.when(functools.reduce(operator.or_, [has_value(p, "path") for p in ps]), F.lit(s)) for s, ps in paths.items()]))
    listed = sensor_list(c)
    return F.when(F.size(listed) > 0, listed).otherwise(F.array_sort(found))


def row_signature(columns: Sequence[Column | str]) -> Column:
    """A digest of the columns' texts; null and empty differ."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in columns]), 256)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row, the same for the same rows in any order."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.bit_xor(h).alias("xor_hash"), F.sum(h.cast("decimal(38,0)")).alias("sum_hash"), F.count("*").alias("n_rows"))


def hash_fraction(c: Column | str) -> Column:
    """A stable fraction in [0, 1] from the first 8 hex digits of the key's MD5."""
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_missing) in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in columns])).alias("x")).select("x.*")


def has_text(c: Column | str) -> Column:
    """the text is more than white space (null: no)."""
    return F.coalesce(F.length(F.trim(_col(c))) > 0, F.lit(False))
