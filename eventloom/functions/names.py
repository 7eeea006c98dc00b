"""Product, scene and file names to fields, and paths from fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eventloom.functions.clean import _col


# The patterns below are facts of the products' file-name formats.


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A regular expression's group, null where nothing matches."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def ten_minutes(ts: Column | str) -> Column:
    return F.floor(F.unix_timestamp(_col(ts).cast("timestamp")) / 600)


def overpass_s2(name: Column | str, ts: Column | str) -> Column:
    """Relative orbit and ten-minute slot."""
    return F.concat_ws("_", F.coalesce(extract(name, r"_(R\d{3})_"), F.lit("R")), ten_minutes(ts).cast("string"))


def overpass_s5p(name: Column | str, ts: Column | str) -> Column:
    """Orbit in the name, else the date, else the name."""
    return F.coalesce(extract(name, r"_(\d{5})_\d{2}_"), F.date_format(_col(ts).cast("timestamp"), "yyyyMMdd"), _col(name))


def overpass_emit(name: Column | str) -> Column:
    """The seven-digit orbit, else the name."""
    return F.coalesce(extract(name, r"_(\d{7})_"), _col(name))


def overpass_l89(spacecraft: Column | str, path: Column | str, ts: Column | str) -> Column:
    """Spacecraft, path and date; rows of one path are one overpass."""
    return F.concat_ws("|", _col(spacecraft), _col(path), F.date_format(_col(ts).cast("timestamp"), "yyyyMMdd"))


def group_id(c: Column | str) -> Column:
    """P25: the id without a trailing hyphen and letters."""
    return F.regexp_replace(_col(c), r"-[A-Za-z]+$", "")


def granule_like(c: Column | str) -> Column:
    """P25: a LIKE pattern for the granule an id of the form xxxYYYYMMDDtHHMMSS... comes from."""
    stamp = extract(c, r"(\d{8}t\d{6})")
    return F.when(stamp.isNotNull(), F.concat(F.lit("%_"), F.upper(stamp), F.lit("_%")))


def swath_fields(c: Column | str) -> Column:
    """Processing, orbit, start and end of a swath file name."""
    p = r"^S5P_(\w{4})_L2__CH4____(\d{8}T\d{6})_(\d{8}T\d{6})_(\d{5})_"
    return F.struct(extract(c, p, 1).alias("proc"), extract(c, p, 4).cast("int").alias("orbit"), F.try_to_timestamp(extract(c, p, 2), F.lit("yyyyMMdd'T'HHmmss")).alias("t_start"), F.try_to_timestamp(extract(c, p, 3), F.lit("yyyyMMdd'T'HHmmss")).alias("t_end"))


def scene_fields(c: Column | str) -> Column:
    """Spacecraft, level, path, row, date and tier of a Landsat scene id."""
    part = lambda i: F.split_part(_col(c), F.lit("_"), F.lit(i))
    return F.struct(part(1).alias("spacecraft"), part(2).alias("level"), F.substring(part(3), 1, 3).alias("wrs_path"), F.substring(part(3), 4, 3).alias("wrs_row"), F.try_to_timestamp(part(4), F.lit("yyyyMMdd")).cast("date").alias("acquired"), part(7).alias("tier"))


def scene_files(c: Column | str, bands: tuple[str, ...]) -> Column:
    """The files that a complete scene has; explode it for rows."""
    return F.array(*[F.concat(_col(c), F.lit(f"_{b}")) for b in bands])


def double_underscore(c: Column | str) -> Column:
    """The fields of an export name that `__` separates."""
    return F.split(_col(c), "__")


def processing_level(path: Column | str) -> Column:
    """OFFL, RPRO or NRTI in a path."""
    return extract(path, r"(OFFL|RPRO|NRTI)")


def needed_offsets(have: dict[int, Column]) -> Column:
    """The offsets in days still wanted, as 90;360."""
    return F.array_join(F.array_compact(F.array(*[F.when(~ok, str(d)) for d, ok in have.items()])), ";")


def parse_centers(c: Column | str) -> Column:
    """P34: 'cy,cx;cy,cx' as structs; parts that are no two integers go."""
    pairs = F.transform(F.split(F.coalesce(_col(c), F.lit("")), ";"), lambda p: F.struct(F.trim(F.split_part(p, F.lit(","), F.lit(1))).try_cast("int").alias("cy"), F.trim(F.split_part(p, F.lit(","), F.lit(2))).try_cast("int").alias("cx")))
    return F.filter(pairs, lambda p: p["cy"].isNotNull() & p["cx"].isNotNull())


def encode_centers(a: Column | str) -> Column:
    """The text again."""
    return F.array_join(F.transform(_col(a), lambda p: F.concat_ws(",", p["cy"].cast("string"), p["cx"].cast("string"))), ";")


def path_of(*parts: Column | str) -> Column:
    """Parts joined by slashes; null parts are left out."""
    return F.regexp_replace(F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts]), r"(?<!:)/{2,}", "/")


def swap_suffix(path: Column | str, old: str, new: str) -> Column:
    """A path with another suffix; others stay."""
    p = _col(path)
    return F.when(p.endswith(old), F.concat(F.substring(p, F.lit(1), F.length(p) - len(old)), F.lit(new))).otherwise(p)


def sensor_of_log(name: Column | str) -> Column:
    """The sensor that a log file's name tells."""
    n = F.lower(_col(name))
    return F.when(n.contains("s5p"), "S5P").when(n.contains("s2"), "S2").when(n.contains("emit"), "EMIT").when(n.contains("l89") | n.contains("landsat"), "L89")


def path_columns(path: Column | str, patterns: dict[str, tuple[str, str]]) -> list[Column]:
    """Named columns of a path, each by a pattern's first group and a type; null where it doesn't match or cast."""
    return [extract(path, pattern).try_cast(kind).alias(name) for name, (pattern, kind) in patterns.items()]


def level_mix(*paths: Column | str) -> Column:
    """the processing level that all paths share, `mixed` for several, null where no path tells one."""
    levels = F.array_distinct(F.array_compact(F.array(*[processing_level(p) for p in paths])))
    return F.when(F.size(levels) == 1, levels[0]).when(F.size(levels) > 1, "mixed")
